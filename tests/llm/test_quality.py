"""Quality rules against plain Python, and on the labelled documents."""

import math
import re
from collections import Counter

import pytest

from irspark.llm import quality
from irspark.llm.query_quality import op6_quality
from irspark.llm.registry import table

from .conftest import DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(inside), n < 20 or 100 * len(inside) > 30 * n)


def got(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_op6_whole_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, DIR, "documents").collect()}
    out = op6_quality(spark, DIR).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        assert got(r) == base(docs[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_odd_rows(spark, documents):
    texts = [None, "", " \n\t\n", "a", "Ä ö ü\x1c \x85 🙂 &<>", "x y\n" * 400, "one line\r\none line\n\n\none line",
             " ".join(f"w{i % 40}" for i in range(300)), "z" * 300_000, "q " * 200_000, "a b c d e f g h a b c d e f g h"]
    rows = [(None if i == 3 else i, t, [None, "en", "EN-gb", "??", ""][i % 5]) for i, t in enumerate(texts)] + [(1, "")]
    out = quality.judge(documents(rows).withColumnRenamed("n_chars", "kept")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert got(r) == base(r.text)
    assert quality.judge(documents([])).count() == 0


def test_language(spark):
    rows = [(x,) for x in ("en", "EN-us", "deu", "x", "", None, "e1", "english", "pt_BR")]
    out = spark.createDataFrame(rows, "lang string").select("lang", quality.language(quality.F.col("lang")).alias("c"))
    assert [r.c for r in out.collect()] == ["en", "en", "deu", "und", "und", "und", "und", "und", "pt"]


def test_distance():
    import numpy as np

    p, q = np.array([0.5, 0.5, 0.0]), np.array([0.25, 0.25, 0.5])
    m = (p + q) / 2
    kl = [sum(a * math.log2(a / b) for a, b in zip(x, m) if a) for x in (p, q)]
    assert quality.distance(p, q) == pytest.approx(math.sqrt(sum(kl) / 2))
    assert quality.distance(p, p) == 0
    assert quality.distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)


def test_references_are_exact_shares(spark, documents):
    rows = [(i, "the Cat The end" if i % 2 else "cat sat", "en") for i in range(50)] + [(99, "le chat", "fr"), (7, None, "de")]
    refs = quality.references(documents(rows), quality.Limits(smoothing_words=10, common_share=0.01))
    counts = {"en": Counter(the=50, cat=50, end=25, sat=25), "fr": Counter(le=1, chat=1), "de": Counter()}
    every = sum(counts.values(), Counter())
    n_all = sum(every.values())
    assert set(refs) == set(counts)  # two words, or none, have a reference too
    for lang, own in counts.items():
        want = {w: (own[w] + 10 * every[w] / n_all) / (sum(own.values()) + 10) for w in every}
        assert dict(refs[lang][1]) == pytest.approx({w: s for w, s in want.items() if s >= 0.01})
        assert sum(refs[lang][0]) == pytest.approx(1)


def test_a_rare_language_is_judged(spark):
    """Documents of every language are compared, whatever the size of the table; clean ones stay."""
    for sf in ("0.001", "0.01"):
        d = f"/root/testdata/sf{sf}"
        docs = table(spark, d, "documents")
        labels = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
        out = quality.judge(docs).select("doc_id", "lang", "n_words", "base_failed", "kept", "word_distance").collect()
        assert all((r.word_distance is not None) == (r.n_words >= 60) for r in out)
        clean = [r.kept for r in out if not r.base_failed and labels.get(r.doc_id) == 1]
        assert clean.count(False) <= 0.005 * len(clean)
        junk = [r.kept for r in out if not r.base_failed and labels.get(r.doc_id) == 0]
        assert junk.count(False) >= 0.9 * len(junk)


def test_junk_goes_and_clean_documents_stay(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
    out = [r for r in op6_quality(spark, d).collect() if r.doc_id in labels and not r.base_failed]
    clean = [r.kept for r in out if labels[r.doc_id] == 1]
    junk = [r.kept for r in out if labels[r.doc_id] == 0]
    assert clean.count(False) <= 0.001 * len(clean)
    assert junk.count(False) >= 0.9 * len(junk)
