"""Near duplicates and components against all pairs."""

import random

import numpy as np
import pytest

from irspark.llm import minhash
from irspark.llm.components import components
from irspark.llm.query_dedup import op3_minhash
from irspark.llm.registry import table

from .conftest import DIR


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    links += [(900, i) for i in range(700, 800)] + [(999, 999), (5, 5)]
    out = components(spark.createDataFrame(links, "a int, b int")).collect()
    nodes = {x for p in links for x in p}
    assert {r.node: r.root for r in out} == roots(nodes, links)
    assert len(out) == len(nodes)
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def word_set(text, width):
    words = (text or "").encode().lower().split()
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def all_pairs(rows, width):
    sets = [word_set(t, width) for _, t in rows]
    links = []
    for i, a in enumerate(sets):
        for k in range(i):
            b = sets[k]
            shared = len(a & b)
            if shared and 100 * shared >= 80 * (len(a) + len(b) - shared):
                links.append((k, i))
    found = roots(range(len(rows)), links)
    members = {}
    for i, root in found.items():
        members.setdefault(root, []).append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in members[found[i]] if x is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return out


def shown(out):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_op3_whole_table(spark, sf):
    d = DIR.replace("0.001", sf)
    rows = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    out = op3_minhash(spark, d).collect()
    assert shown(out) == sorted(all_pairs(rows, 2), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def edited(words, n, r):
    words = list(words)
    for i in r.sample(range(len(words)), n):
        words[i] = f"x{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("hot", [False, True])
def test_large_groups_of_near_copies(spark, documents, hot, request):
    if hot:
        request.getfixturevalue("tiny_limits")
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(1000 + i, edited(base, r.randrange(0, 14), r)) for i in range(150)]
    # A chain: each is similar to the next one only, so most links are not to a leader.
    chain = [" ".join(f"c{k}" for k in range(i * 5, i * 5 + 100)) for i in range(40)]
    rows += [(3000 + i, t) for i, t in enumerate(chain)]
    r.shuffle(rows)
    out = minhash.near_duplicates(documents(rows), width=2).collect()
    assert shown(out) == sorted(all_pairs(rows, 2), key=str)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\ttwo"), (8, "two one"),
            (None, "lone text without id"), (None, "one two"), (None, None), (9, "É"), (10, "é"), (11, "w " * 100_000),
            (12, "w w"), (13, "a b c d e f g h i j"), (13, "a b c d e f g h i j"), (14, "a b c d e f g h i k")]
    docs = documents(rows).withColumnRenamed("lang", "id").withColumnRenamed("source", "kept")
    assert shown(minhash.near_duplicates(docs, width=2).collect()) == sorted(all_pairs(rows, 2), key=str)
    assert shown(minhash.near_duplicates(docs, width=5).collect()) == sorted(all_pairs(rows, 5), key=str)
    assert minhash.near_duplicates(documents([])).count() == 0


def test_sketches_fill_and_estimate():
    r = np.random.default_rng(1)
    for n, shared in ((1, 1), (3, 2), (50, 40), (2000, 1600)):
        x = r.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
        a, b = x[:n], x[n - shared :]
        trials = [minhash.sketch([a ^ np.uint64(i << 40), b ^ np.uint64(i << 40)]) for i in range(40)]
        assert all((t != np.uint64(2**64 - 1)).all() for t in trials)
        agreement = np.mean([(t[0] == t[1]).mean() for t in trials])
        assert agreement == pytest.approx(shared / len(x), abs=0.1 if n < 10 else 0.03)


def test_small_groups_near_the_threshold(spark, documents):
    """Buckets with equal members are read once; a pair must not wait for one that is not read."""
    r = random.Random(7)
    rows = []
    for g in range(240):
        for _ in range(r.randrange(4, 7)):
            own = [f"o{r.randrange(10**9)}" for _ in range(r.randrange(9, 18))]
            rows.append((len(rows), " ".join([f"g{g}c{i}" for i in range(100)] + own)))
    sets = [word_set(t, 1) for _, t in rows]
    groups = {}
    for i, (_, t) in enumerate(rows):
        groups.setdefault(t.split()[0], []).append(i)
    links = [(a, b) for ids in groups.values() for a in ids for b in ids
             if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(range(len(rows)), links)
    assert {x.doc_id: x.component_id for x in minhash.near_duplicates(documents(rows), width=1).collect()} == want
