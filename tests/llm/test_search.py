"""Exact top-k search against brute force."""

import numpy as np
import pytest

from checks.compare import compare, connect
from irspark.llm import topk
from irspark.llm.query_search import op4_top
from irspark.llm.registry import SQL

from .conftest import DIR


def brute(ids, vectors, query_id, query, k):
    rows = sorted(((-int(v @ query), int(i)) for i, v in zip(ids, vectors) if i != query_id))
    return [(i, -s) for s, i in rows[:k]]


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_op4_matches_sql(spark, sf):
    d = DIR.replace("0.001", sf)
    assert compare(op4_top(spark, d), connect(d), SQL["op4_top"]) is None


@pytest.mark.parametrize("n, dim, high", [(3, 4, 9), (5, 1, 2), (400, 8, 3), (700, 16, 300), (300, 5, 2**40)])
def test_lists_equal_brute_force(n, dim, high):
    r = np.random.default_rng(n)
    ids = r.permutation(3 * n)[:n].astype(np.int64)
    vectors = r.integers(-high, high, (n, dim))
    lists = topk.Lists(ids, vectors)
    queries = np.array([vectors[i % n] if i % 3 else r.integers(-high, high, dim) * (r.random(dim) < 0.4) for i in range(30)])
    if high > 2**30:
        queries = queries % 1000
    asking = ids[np.arange(30) % n]
    for i, got in enumerate(lists.best(asking, queries, 5)):
        assert list(zip(got[0].tolist(), got[1].tolist())) == brute(ids, vectors, asking[i], queries[i], 5)


def test_reading_stops_early():
    r = np.random.default_rng(1)
    centres = r.normal(size=(10, 32))
    vectors = np.floor(256 * (centres[r.integers(0, 10, 4000)] + 0.1 * r.normal(size=(4000, 32)))).astype(np.int64)
    lists = topk.Lists(np.arange(4000), vectors)
    may = np.arange(4000)[None, :] != np.arange(20)[:, None]
    assert np.median(lists._reaching(vectors[:20].astype(float), 5, may).sum(axis=1)) < 2000


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "_VECTORS", 7)
    monkeypatch.setattr(topk, "_QUERIES", 2)
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(2)
    good = [(i, [float(x) for x in r.normal(size=3)]) for i in range(60)]
    ties = [(100 + i, [1.0, 1.0, 1.0]) for i in range(12)]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0]), (203, [nan, 0.0, 0.0]), (204, [1.0, -inf, 0.0]), (None, [9.0] * 3)]
    other = [(300, [5.0, 5.0]), (350, [1.0, 2.0])]
    rows = [(*x, 1) for x in good + ties + bad + other + good[:3] + ties[:2]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int").repartition(3)
    out = topk.search(vectors, vectors.filter("vec_id % 50 = 0 or vec_id is null"), 5).collect()
    usable = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64) for i, v in good + ties + other}
    for q in (0, 50, 100, 300, 350):
        same = {i: v for i, v in usable.items() if len(v) == len(usable[q])}
        want = brute(list(same), list(same.values()), q, usable[q], 5)
        assert [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] == want
    assert {r.query_id for r in out} == {0, 50, 100, 300, 350}
    assert topk.search(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_repeated_queries_are_not_broadcast(spark, monkeypatch):
    """Queries are repeated once a block, which the planner's estimate doesn't see: a broadcast of them would not fit."""
    monkeypatch.setattr(topk, "_VECTORS", 9)
    monkeypatch.setattr(topk, "_QUERIES", 4)
    r = np.random.default_rng(3)
    ids, values = np.arange(300), r.integers(-9, 9, (300, 6))
    vectors = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, values)], "vec_id bigint, embedding array<float>")
    found = topk.search(vectors, vectors.filter("vec_id % 7 = 0"), 3, scale=1)
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    for q in range(0, 300, 7):
        got = [(x.vec_id, x.score) for x in sorted(rows, key=lambda x: x["rank"]) if x.query_id == q]
        assert got == brute(ids, values, q, values[q], 3)
