import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from irspark.operators import graph
from irspark.sources import graph as GS


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def brute_pagerank(pairs, ids, rounds, alpha=0.85):
    n = len(ids)
    rank = {i: 1 / n for i in ids}
    out = {i: [d for s, d in pairs if s == i] for i in ids}
    for _ in range(rounds):
        lost = sum(rank[i] for i in ids if not out[i])
        new = {i: 0.0 for i in ids}
        for i in ids:
            for dst in out[i]:
                new[dst] += rank[i] / len(out[i])
        rank = {i: alpha * (new[i] + lost / n) + (1 - alpha) / n for i in ids}
    return rank


PAIRS = [("a", "b"), ("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "e")]


@pytest.mark.parametrize("every", [1, 3])
def test_pagerank(spark, every):
    got = {r.id: r["rank"] for r in graph.pagerank(edges(spark, PAIRS), iterations=10, checkpoint_every=every).collect()}
    want = brute_pagerank(PAIRS, "abcde", 10)
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}
    assert sum(got.values()) == pytest.approx(1.0)


def test_pagerank_isolated_vertex(spark):
    extra = spark.createDataFrame([("z",), ("a",)], "id string")
    got = {r.id: r["rank"] for r in graph.pagerank(edges(spark, PAIRS), iterations=4, vertices=extra).collect()}
    want = brute_pagerank(PAIRS, "abcdez", 4)
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}


def test_pagerank_hub_is_cut_into_parts(spark, tiny_limits):
    pairs = [("hub", f"v{i}") for i in range(200)] + [(f"v{i}", "hub") for i in range(100)]
    got = {r.id: r["rank"] for r in graph.pagerank(edges(spark, pairs), iterations=3).collect()}
    want = brute_pagerank(pairs, {x for p in pairs for x in p}, 3)
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}


def test_rounds_move_packed_blocks(spark, tiny_limits, monkeypatch):
    """A round sends one row per block of vertices; edges with a null end and sinks count as before."""
    pairs = [(f"v{i % 37}", f"v{i * i % 50}") for i in range(400)] + [("v1", None), ("v2", None), (None, "v3")]
    moved = []
    products = graph.products
    monkeypatch.setattr(graph, "products", lambda cells, matrix, vectors, *a: (
        moved.append((vectors.count(), cells.count(), len(matrix.places))), products(cells, matrix, vectors, *a))[1])
    got = {r.id: r["rank"] for r in graph.pagerank(edges(spark, pairs), iterations=4).collect()}
    known = {x for p in pairs for x in p}
    n, rank = len(known), dict.fromkeys(known, 1 / len(known))
    out = {i: [d for s, d in pairs if s == i] for i in known - {None}}
    for _ in range(4):
        lost = sum(rank[i] for i in known if not out.get(i))
        new = dict.fromkeys(known, 0.0)
        for i, to in out.items():
            for dst in to:
                new[dst] += rank[i] / len(to)
        new[None] = 0.0
        rank = {i: 0.85 * (new[i] + lost / n) + 0.15 / n for i in known}
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in rank.items()}
    assert len(moved) == 4 and all(v <= 4 and c < 150 and cells == 16 for v, c, cells in moved)


@pytest.mark.parametrize("normalize", [False, True])
def test_hits(spark, normalize):
    ids = "abcde"
    hub = dict.fromkeys(ids, 1.0)
    auth = dict.fromkeys(ids, 1.0)
    for _ in range(5):
        new_hub = {i: sum(auth[d] for s, d in PAIRS if s == i) for i in ids}
        new_auth = {i: sum(hub[s] for s, d in PAIRS if d == i) for i in ids}
        if normalize:
            for v in (new_hub, new_auth):
                size = sum(x * x for x in v.values()) ** 0.5
                v.update({k: x / size for k, x in v.items()})
        hub, auth = new_hub, new_auth
    got = graph.hits(edges(spark, PAIRS), iterations=5, normalize=normalize).collect()
    assert {r.id: r.hub for r in got} == {k: pytest.approx(v) for k, v in hub.items()}
    assert {r.id: r.authority for r in got} == {k: pytest.approx(v) for k, v in auth.items()}


def test_link_graph(spark):
    pages = spark.createDataFrame(
        [("https://h.x/a/", '<a href="b">1</a><a href="http://h.x/c/">2</a><a href="http://o.x/">3</a>'), ("http://h.x/e", "<p>")],
        "url string, html string",
    )
    got = {r.url: r.links for r in graph.link_graph(pages, "h.x").collect()}
    assert got == {"http://h.x/a": ["http://h.x/b", "http://h.x/c"], "http://h.x/e": []}
    stats = graph.graph_stats(graph.link_graph(pages, "h.x")).first()
    assert (stats.pages, stats.without_links, stats.share) == (2, 1, 0.5)


def test_numbering_and_top(spark):
    g = spark.createDataFrame([("u", ["v", "w", "v"]), ("u", ["v"]), ("x", [])], "url string, links array<string>")
    merged = {(r.url, r.link): r.times for r in graph.merge_adjacency(g).collect()}
    assert merged == {("u", "v"): 3, ("u", "w"): 1, ("x", None): 0}
    dictionary, numbered = graph.number_urls(g)
    assert [(r.id, r.url) for r in dictionary.orderBy("id").collect()] == [(0, "u"), (1, "v"), (2, "w"), (3, "x")]
    assert {(r.id, r.link_id, r.times) for r in numbered.collect()} == {(0, 1, 3), (0, 2, 1), (3, None, 0)}
    ranks = spark.createDataFrame([(0, 0.1), (1, 0.5), (2, 0.5)], "id long, rank double")
    assert [r.url for r in graph.top_n(ranks, dictionary, 2).collect()] == ["v", "w"]


def test_typed_top(spark):
    s = spark.createDataFrame([("<person1>", 2.0), ("<person2>", 2.0), ("<series1>", 9.0)], "id string, hub double")
    assert [r.id for r in graph.top_vertices(graph.of_type(s, "person"), "hub", 1).collect()] == ["<person1>"]


def test_adjacency_text(spark, tmp_path):
    lines = spark.createDataFrame([("u\t0.5\t[a, b]",), ("v\t\t[]",), ("w\t1.0\t",), ("bad line",)], "value string")
    got = {r.url: (r.value, r.links) for r in GS.parse_adjacency(lines).collect()}
    assert got == {"u": (0.5, ["a", "b"]), "v": (None, []), "w": (1.0, None)}
    assert [r.value for r in GS.malformed_lines(lines).collect()] == ["bad line"]
    path = str(tmp_path / "adj")
    GS.write_adjacency(GS.parse_adjacency(lines), path)
    assert {r.url: (r.value, r.links) for r in GS.read_adjacency(spark, path).collect()} == got


def test_long_adjacency_is_cut(spark):
    e = spark.range(1000).select(F.lit("u").alias("url"), F.concat(F.lit("l"), "id").alias("link"))
    rows = GS.adjacency_lists(e, 100).collect()
    assert sum(len(r.links) for r in rows) == 1000 and max(len(r.links) for r in rows) < 200


def test_edge_list_and_dictionary(spark, tmp_path):
    (tmp_path / "edges.txt").write_text(" a   b \nc\td\n\n")
    assert {(r.src, r.dst) for r in GS.read_edges(spark, str(tmp_path / "edges.txt")).collect()} == {("a", "b"), ("c", "d")}
    d = spark.createDataFrame([(0, "u"), (1, "v")], "id long, url string")
    GS.write_dictionary(d, str(tmp_path / "dict"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "dict")).collect()]
    assert sorted(lines) == ["0\tu", "1\tv", "2"]
    assert {(r.id, r.url) for r in GS.read_dictionary(spark, str(tmp_path / "dict")).collect()} == {(0, "u"), (1, "v")}
    (tmp_path / "urls.txt").write_text("7\thttps://h.x/a/\n")
    assert GS.read_page_urls(spark, str(tmp_path / "urls.txt")).first().url == "http://h.x/a"


def test_rounds_leave_one_table(spark):
    """Tables of earlier rounds are dropped; the scores read the last one."""
    from pathlib import Path

    from irspark.plans.lineage import checkpoint_dir

    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3), (4, 4)], "src long, dst long")
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    for run in (lambda: graph.pagerank(e, iterations=6), lambda: graph.hits(e, 6), lambda: graph.hits(e, 6, normalize=True)):
        before = {p.name for p in folder.iterdir()} | {t.name for t in spark.catalog.listTables()}
        out = run()
        after = {p.name for p in folder.iterdir()} | {t.name for t in spark.catalog.listTables()}
        assert len(after - before) == 1
        assert out.count() == 4
    assert graph.pagerank(e.limit(0), iterations=2).count() == 0
    assert graph.hits(e, 0).count() == 4 and graph.pagerank(e, iterations=0).count() == 4


@pytest.mark.parametrize("split", [False, True])
def test_lines_of_one_link_and_of_none(spark, tmp_path, request, split):
    """Copies of one link fill several lines; the edge rows come back as they were."""
    if split:
        request.getfixturevalue("tiny_limits")
    rows = [("hot", "x")] * 2500 + [("hot", "y"), ("hot", "a"), ("none", None), ("both", None), ("both", "z"), ("one", "z")]
    e = spark.createDataFrame(rows, "url string, link string")
    out = GS.adjacency_lists(e, 1000).collect()
    assert max(len(r.links) for r in out) <= 1000
    found = {}
    for r in out:
        found.setdefault(r.url, []).extend(r.links)
    assert {u: sorted(x) for u, x in found.items()} == {
        "hot": sorted(["x"] * 2500 + ["y", "a"]), "none": [], "both": ["z"], "one": ["z"]}
    if not split:
        assert sorted(len(r.links) for r in out if r.url == "hot") == [502, 1000, 1000]
    counted = GS.edge_rows(e)
    GS.write_edge_rows(counted, str(tmp_path / "rows"))
    back = GS.read_edge_rows(spark, str(tmp_path / "rows")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(map(tuple, counted.collect()), key=str)
    assert GS.adjacency_lists(e.limit(0)).count() == 0


def test_rows_of_cells_are_bounded(monkeypatch):
    """Pieces of a cell are put together to rows of about _CHUNK edges; pieces without weights count 1 an edge."""
    made = sys.modules[graph.grid.__module__]
    monkeypatch.setattr(made, "_CHUNK", 40)
    ends = [np.arange(i, i + 15, dtype="<i4").tobytes() for i in range(20)]
    weights = [None if i % 3 else np.full(15, 2.0).astype("<f8").tobytes() for i in range(20)]
    columns = {"cell": [i % 2 for i in range(20)], "late": [False] * 20, "src": ends, "dst": ends, "weight": weights}
    batch = pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary()) if k in ("src", "dst", "weight") else v for k, v in columns.items()})
    rows = pa.Table.from_batches(list(made._gathered(iter([batch.slice(0, 7), batch.slice(7)])))).to_pylist()
    assert max(len(r["src"]) for r in rows) <= 4 * (40 + 15) and len(rows) == 8
    for cell in (0, 1):
        own = [r for r in rows if r["cell"] == cell]
        assert b"".join(r["src"] for r in own) == b"".join(r["dst"] for r in own) == b"".join(ends[cell::2])
        total = sum(np.frombuffer(r["weight"]).sum() if r["weight"] else len(r["src"]) / 4 for r in own)
        assert total == sum(15 if w is None else 30 for w in weights[cell::2])


def test_cells_stream_in_rows(spark, monkeypatch):
    """A task never holds a cell: its edges are rows of bounded length that pass one after another."""
    pairs = [(f"v{i * i % 31}", f"v{(i * 7) % 50}") for i in range(600)] + [("v1", None), ("v3", "v3")]
    want = {r.id: (r.hub, r.authority) for r in graph.hits(edges(spark, pairs), iterations=3).collect()}
    made, plans = [], []
    grid, products = graph.grid, graph.products
    for limit, rows in (("_PACK", 30), ("_CHUNK", 40), ("_AT_ONCE", 16)):
        monkeypatch.setattr(sys.modules[grid.__module__], limit, rows, raising=False)

    def spied_grid(*a):
        matrix = grid(*a)
        made.extend(matrix.cells.rows.select("cell", F.length("src").alias("bytes")).collect())
        return matrix

    def spied_products(*a):
        found = products(*a)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(graph, "grid", spied_grid)
    monkeypatch.setattr(graph, "products", spied_products)
    known = {x for p in pairs for x in p if x}
    got = {r.id: r["rank"] for r in graph.pagerank(edges(spark, [p for p in pairs if p[1]]), iterations=4).collect()}
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in brute_pagerank([p for p in pairs if p[1]], known, 4).items()}
    assert len(made) > len({r.cell for r in made})
    found = {r.id: (r.hub, r.authority) for r in graph.hits(edges(spark, pairs), iterations=3).collect()}
    assert found == {k: pytest.approx(v) for k, v in want.items()}
    assert plans and all("MapInArrow" in p and "FlatMapCoGroupsInArrow" not in p for p in plans)
    # The edges stay in their buckets: only the values move.
    assert all("SelectedBucketsCount" in p for p in plans)
