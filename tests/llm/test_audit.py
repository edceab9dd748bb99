"""Divergence of sources against SQL and brute force."""

import re
from collections import Counter, defaultdict

import pytest

from checks.compare import compare, connect
from irspark.llm import divergence
from irspark.llm.query_audit import op11_divergence
from irspark.llm.registry import SQL

from .conftest import DIR


@pytest.mark.parametrize("block, held", [(4096, 300_000), (5, 40)])
def test_op11_matches_sql(spark, monkeypatch, block, held):
    monkeypatch.setattr(divergence, "_BLOCK_ROWS", block)
    monkeypatch.setattr(divergence, "_TERMS_HELD", held)
    monkeypatch.setattr(divergence, "_PAIRS_HELD", held)
    assert compare(op11_divergence(spark, DIR), connect(DIR), SQL["op11_divergence"]) is None


def test_op11_with_hot_keys(spark, tiny_limits):
    assert compare(op11_divergence(spark, DIR), connect(DIR), SQL["op11_divergence"]) is None


def brute(rows, min_docs, top):
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang, seen in docs.items():
        kept = [t for t, n in seen.items() if n >= min_docs]
        groups = {s: c for (la, s), c in counts.items() if la == lang}
        all_ = Counter()
        for c in groups.values():
            all_.update(c)

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        q = shares(all_)
        for s, c in groups.items():
            p = shares(c)
            pairs = []
            for other, d in groups.items():
                if other != s:
                    o = shares(d)
                    pairs.append((-sum((p[t] - o[t]) ** 2 // o[t] for t in kept), other.encode()))
            terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if c[t] and p[t] > q[t]]
            for part, values in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(values)]
    return sorted(out)


def test_odd_rows(spark, documents):
    words = ["alpha beta", "alpha ALPHA gamma", "Éa éa alpha", "beta beta beta", "你好 alpha", "", None, "123 !?", "gamma x" * 500]
    rows = [(w, lang, src) for w in words for lang in ("en", None, "xx") for src in ("a", "b", None)]
    rows += [("alpha", "en", "é"), ("only once", "lonely", "a"), (None, "none", "a"), (None, "none", "b"), ("t t t t", "one", "z")] * 2
    docs = documents([(None, *r) for r in rows]).withColumnsRenamed({"doc_id": "term", "n_chars": "value"})
    out = divergence.audit(docs, min_docs=3, top=2)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == brute(rows, 3, 2)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_large_counts():
    shares = divergence._shares([0, 10**12, 3 * 10**12], 4 * 10**12, 7)
    assert shares.tolist() == [1 + 10**9 * (c + 1) // (4 * 10**12 + 7) for c in (0, 10**12, 3 * 10**12)]
