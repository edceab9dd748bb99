"""Language of texts: filters against exact sets, accuracy on held-out documents."""

from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from irspark.llm import language
from irspark.llm.query_language import op13_language

from .conftest import DIR


def test_held_out_accuracy(spark):
    for sf in ("0.001", "0.01"):
        d = DIR.replace("0.001", sf)
        docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
        rows = op13_language(spark, d).join(docs, "doc_id").collect()
        assert len(rows) == docs.count()
        assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
        held = [r.lang == r.lang_pred for r in rows if r.held_out]
        assert len(held) > 30 and np.mean(held) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string")).write.parquet(
        f"{tmp_path}/documents.parquet")
    assert sorted(op13_language(spark, str(tmp_path)).collect()) == sorted(op13_language(spark, DIR).collect())


def own_grams(text):
    """N-grams of the words of a text, one after the other."""
    kept = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    return [f" {w} "[i : i + n] for n in language.LENGTHS for w in kept.split() for i in range(len(w) + 3 - n)]


def test_grams_by_hand():
    texts = ["Ein Haus, 2 Äpfel!", "", None, "a", "éa 你好", "!!", "x" * 300]
    keys, owner, has = language.grams(texts)
    assert has.tolist() == [True, False, False, True, True, False, True]
    known = {}
    for i, t in enumerate(texts):
        own = own_grams(t or "")
        assert (owner == i).sum() == len(own)
        alone = language.grams([t])[0]
        assert sorted(alone.tolist()) == sorted(keys[owner == i].tolist())
        assert len(set(alone.tolist())) == len(set(own))
        for g in set(own):
            known.setdefault(g, set())
    assert len(set(keys.tolist())) == len(known)


def test_filters_against_exact_sets(spark, documents):
    """Corrected hits are close to what exact sets of n-grams give, also for more languages than one mask holds."""
    r = np.random.default_rng(3)
    names = [f"l{i:02}" for i in range(70)]
    letters = [r.choice([chr(0x100 + c) for c in range(200)], 12, replace=False) for _ in names]

    def text(i, n=60):
        return " ".join("".join(r.choice(letters[i], 4)) for _ in range(n))

    rows = [(k * 70 + i, text(i), name) for k in range(3) for i, name in enumerate(names)]
    filters = language.fit(documents(rows))
    assert sorted(filters.names) == names and filters.masks.shape == (2, language._ROWS)
    sets = {n: {g for _, t, lang in rows if lang == n for g in own_grams(t)} for n in names}
    tests = [(i, text(i, 20)) for i in range(70)]
    found, score = filters.predict([t for _, t in tests])
    for (i, t), name, s in zip(tests, found, score):
        own = own_grams(t)
        exact = {n: sum(g in sets[n] for g in own) for n in names}
        assert max(exact, key=exact.get) == name == names[i]
        assert abs(s - exact[name] / sum(exact.values())) < 0.1


def test_odd_rows(spark, documents):
    rows = [(1, "der die das und", "de"), (2, "the and of to", "en"), (3, None, "en"), (4, "", "en"), (5, "123 !", "de"),
            (6, "the cat and the dog", None), (7, "привет", "en"), (2, "the and of to", "en"), (None, "the the", "en"), (8, "the " * 50_000, "en")]
    docs = documents(rows).withColumnsRenamed({"source": "score", "n_chars": "gram"})
    out = language.predict(docs, language.fit(docs))
    assert out.columns == ["doc_id", "text", "lang", "gram", "lang_pred", "score"]
    found = {r.doc_id: (r.lang_pred, r.score > 0) for r in out.collect()}
    assert found[1] == ("de", True) and found[2] == found[6] == found[8] == found[None] == ("en", True)
    assert found[3] == found[4] == found[5] == ("und", False)
    assert out.count() == len(rows)
    nothing = language.predict(docs, language.fit(docs.filter("lang is null")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    only = language.predict(docs, language.fit(docs.filter("lang = 'de'")))
    assert {(r.lang_pred, r.score) for r in only.filter("doc_id = 7").collect()} == {("de", 0.0)}
    assert language.predict(docs.limit(0), language.fit(docs.limit(0))).count() == 0
