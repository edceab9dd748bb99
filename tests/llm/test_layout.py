"""Mixing and sharding against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from checks.compare import compare, connect
from irspark.llm import mixing, sharding
from irspark.llm.query_layout import op1_mix, op5_shards
from irspark.llm.registry import SQL, table

from .conftest import DIR


def best(key, shards):
    def score(i):
        u = (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return -1 / math.log(u)

    return max(range(shards), key=score)


def check_shards(out, docs):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    slots = defaultdict(list)
    for r in out:
        key = "" if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (best(key, 8), best(key, 9))
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_op5_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, DIR, "documents").collect()]
    check_shards(op5_shards(spark, DIR).collect(), docs)


def test_shards_odd_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "_ROWS_PER_RANGE", 3)
    monkeypatch.setattr(sharding, "_REPEATS", 4)
    rows = [(i, f"t{i} é") for i in range(60)] + [(None, "x"), (None, None), (None, "x"), (7, ""), (8, "y" * 100_000)]
    rows += [(5, "same")] * 19 + [(None, None)] * 9
    out = sharding.shard_documents(documents(rows).withColumnRenamed("n_chars", "shard"))
    check_shards(out.collect(), rows)
    again = sharding.shard_documents(documents(rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, out.collect()))
    assert sharding.shard_documents(documents([])).count() == 0


def test_weighted_shards(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in sharding.assign(ids, [1.0, 0.0, 3.0]).collect())
    assert n[1] == 0 and 2.8 < n[2] / n[0] < 3.2
    with pytest.raises(ValueError):
        sharding.assign(ids, [0.0])


def water_fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = budget - sum(most * sizes[s] for s in full)
        level = left / sum(w[s] for s in rest) if rest else 0
        over = [s for s in rest if level * w[s] > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in full else level * w[s] for s in names}
        full |= set(over)


def check_mix(out, share=1.5, most=2.0, weights=(5, 2, 1)):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = water_fill(sizes, weights, share, most)
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    return {s: want[s] - taken[s] for s in sizes}


def test_op1_matches_sql(spark):
    assert compare(op1_mix(spark, DIR), connect(DIR), SQL["op1_mix"]) is None


def test_mix_whole_table(spark):
    docs = table(spark, DIR, "documents")
    left = check_mix(mixing.mix(docs, (5, 2, 1), 1.5, 2.0).collect())
    assert all(0 <= x < 1 for x in left.values())


def test_mix_odd_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "_ROWS_PER_RANGE", 4)
    rows = [(i, "w " * (i % 7), None, f"s{i % 3}") for i in range(90)]
    rows += [(None, "a b c", None, None)] * 20 + [(3, "q r", None, "s1")] * 30 + [(200, None, None, "void"), (201, "", None, "")]
    rows += [(300, "v " * 50_000, None, "long")]
    docs = documents(rows).withColumnRenamed("n_chars", "taken")
    out = mixing.mix(docs, (5, 2, 1), 1.5, 2.0).collect()
    assert len(out) == len(rows)
    left = check_mix(out)
    assert all(0 <= x < 60 for x in left.values())  # ties at a cut are rounded down, row by row
    again = mixing.mix(documents(rows[::-1]).withColumnRenamed("n_chars", "taken"), (5, 2, 1), 1.5, 2.0).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_many_sources(spark, documents, tiny_limits):
    rows = [(i, "w " * (i % 50), None, f"s{i % 12}") for i in range(200)]
    assert all(0 <= x < 1 for x in check_mix(mixing.mix(documents(rows), (5, 2, 1), 1.5, 2.0).collect()).values())


def test_mix_nothing(spark, documents):
    assert mixing.mix(documents([]), (5, 2, 1), 1.5, 2.0).count() == 0
    out = mixing.mix(documents([(1, None, None, "a"), (2, "", None, None)]), (5, 2, 1), 1.5, 2.0).collect()
    assert [(r.target, r.taken) for r in out] == [(0.0, 0), (0.0, 0)]
