"""Link graphs: building, numbering, statistics, PageRank, HITS, best vertices."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from irspark.functions.urls import host, normalize_url
from irspark.operators.html import page_links
from irspark.plans.grid import by_block, bytes_of, grid, plus, products, summed
from irspark.plans.limits import BROADCAST_ROWS, limit
from irspark.plans.lineage import Written, materialize, written
from irspark.plans.ordering import row_index, top_rows
from irspark.plans.skew import hot_keys, lookup_join, skew_join

# Workers get the functions of this module with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def attach_urls(pages: DataFrame, urls: DataFrame, key: str = "id") -> DataFrame:
    """Give pages their normalised url from the id -> url side table."""
    table = urls.select(key, normalize_url(F.col("url")).alias("url"))
    return lookup_join(pages, table, [key])


def link_graph(
    pages: DataFrame, wanted_host: str | None = None, url: str = "url", html: str = "html"
) -> DataFrame:
    """Page url and its links on the wanted host (the page's own host when none is given).

    Pages without such links, or without any html, keep an empty list. Everything happens inside
    the page row.
    """
    page = normalize_url(F.col(url))
    wanted: Column = host(F.col("_page")) if wanted_host is None else F.lit(wanted_host)
    text = F.coalesce(F.col(html), F.lit(""))
    return pages.select(page.alias("_page"), text.alias("_html")).select(
        F.col("_page").alias("url"), page_links(F.col("_html"), F.col("_page"), wanted).alias("links")
    )


def edges(graph: DataFrame) -> DataFrame:
    """One row per link: src, dst."""
    return graph.select(F.col("url").alias("src"), F.explode("links").alias("dst"))


def merge_adjacency(graph: DataFrame) -> DataFrame:
    """Merge rows of equal urls: url, link, times. A null link (0 times) marks an empty list."""
    return (
        graph.select("url", F.explode_outer("links").alias("link"))
        .groupBy("url", "link")
        .agg(F.count("link").alias("times"))
    )


def number_urls(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dense ids by url order over sources and targets.

    Returns the dictionary (id, url) and the merged adjacency in ids (id, link_id, times).
    """
    merged = materialize(merge_adjacency(graph))
    names = (
        merged.select("url")
        .unionByName(merged.filter(F.col("link").isNotNull()).select(F.col("link").alias("url")))
        .distinct()
    )
    dictionary = row_index(names, [F.col("url").asc()], "id").select("id", "url")
    sources = skew_join(merged, dictionary, ["url"], salt_on=["link"])
    targets = dictionary.select(F.col("id").alias("link_id"), F.col("url").alias("link"))
    popular = hot_keys(merged, ["link"])
    numbered = skew_join(sources, targets, ["link"], "left", salt_on=["url"], heavy=popular)
    return dictionary, numbered.select("id", "link_id", "times")


def graph_stats(graph: DataFrame, count_targets: bool = False) -> DataFrame:
    """Pages, pages without links and their share; optionally with pages only linked to.

    Rows of equal urls are one page.
    """
    rows = graph.select("url", (F.coalesce(F.size("links"), F.lit(0)) <= 0).cast("int").alias("empty"))
    if count_targets:
        targets = edges(graph).select(F.col("dst").alias("url")).withColumn("empty", F.lit(1))
        rows = rows.unionByName(targets)
    return rows.groupBy("url").agg(F.min("empty").alias("empty")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum("empty").alias("without_links")
    ).withColumn("share", F.col("without_links") / F.col("pages"))


def _merged_edges(graph_edges: DataFrame) -> DataFrame:
    """Equal edges become one row with a count."""
    times = F.sum("times") if "times" in graph_edges.columns else F.count(F.lit(1))
    return graph_edges.groupBy("src", "dst").agg(times.cast("double").alias("times"))


def _vertices(merged: DataFrame, extra: DataFrame | None) -> DataFrame:
    """id, degree, astray (the share of it that leads to a null id), out_n and in_n (edges without nulls), late."""
    known = F.when(F.col("src").isNotNull() & F.col("dst").isNotNull(), 1).otherwise(0)
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("bigint")
    ends = merged.groupBy(F.col("src").alias("id")).agg(
        F.sum("times").alias("degree"), F.sum(F.when(F.col("dst").isNull(), F.col("times"))).alias("astray"),
        F.sum(known).alias("out_n"), zero.alias("in_n"),
    ).unionByName(
        merged.groupBy(F.col("dst").alias("id")).agg(
            none.alias("degree"), none.alias("astray"), zero.alias("out_n"), F.sum(known).alias("in_n")
        )
    )
    if extra is not None:
        named = {"degree": none, "astray": none, "out_n": zero, "in_n": zero}
        ends = ends.unionByName(extra.select("id").withColumns(named))
    sums = ends.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("degree", "astray", "out_n", "in_n")])
    # A null id is a page that nothing leads to or from.
    known_id = F.col("id").isNotNull()
    return sums.withColumns({
        "degree": F.when(known_id, F.col("degree")),
        "astray": F.when(known_id, F.col("astray") / F.col("degree")),
        "late": ~known_id | F.col("degree").isNull(),
    })


def _known(merged: DataFrame) -> DataFrame:
    known = merged.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return known.select("src", "dst", F.col("times").alias("weight"))


def pagerank(
    graph_edges: DataFrame,
    alpha: float = 0.85,
    iterations: int = 50,
    vertices: DataFrame | None = None,
    checkpoint_every: int = 1,
) -> DataFrame:
    """Rank of every vertex after a fixed number of rounds: id, rank.

    Pages without links share their rank among all pages, so ranks add up to 1. Equal edges count
    as often as they occur. `vertices` may name pages that have no edge at all. Only pages with
    links pass rank on, so the others take part in the last round alone: until then their joint
    rank is what the pages with links leave of the total.
    """
    merged = written(_merged_edges(graph_edges), lean=True)
    every = written(_vertices(merged.rows, vertices), lean=True)
    matrix = grid(_known(merged.rows), every.rows)
    merged.release()
    every.release()
    placed = matrix.vertices.rows
    n = max(placed.count(), 1)
    blocks = written(by_block(
        placed.select("block", "pos", "late", "degree", "astray"), _block,
        "block int, size bigint, active bigint, degrees binary, leaks binary, shares binary",
    ), lean=True)
    if not iterations:
        ranks = written(placed.select("id", F.lit(1.0 / n).alias("rank"))).rows
        matrix.release()
        blocks.release()
        return ranks
    state = "block int, packed binary, total double, held double, leaked double"
    ranks, last = by_block(blocks.rows.withColumns({c: F.lit(None).cast(t) for c, t in _PASSED}), _ranks(alpha, n, "start"), state), None
    for i in range(iterations):
        final = i + 1 == iterations
        cells = matrix.cells.rows if final else matrix.cells.rows.filter(~F.col("late"))
        got = products(cells, matrix, ranks.select("block", F.lit(0).alias("kind"), "packed"))
        totals = ranks.select("total", "held", "leaked").join(F.broadcast(blocks.rows.select("block")))
        rows = blocks.rows.unionByName(got.select("block", "part"), True).unionByName(totals, True)
        if final:
            ends = by_block(rows, _ranks(alpha, n, "end"), "block int, pos int, rank double")
        else:
            ranks = by_block(rows, _ranks(alpha, n, "round"), state)
            if (i + 1) % checkpoint_every == 0:
                ranks, last = _next_round(ranks, last)
    out = written(placed.select("id", "block", "pos").join(ends, ["block", "pos"]).select("id", "rank"), lean=True)
    for table in (matrix, blocks, *([last] if last else [])):
        table.release()
    return out.rows


# What the rows of a round hold besides a block: partial sums, and the totals of the round before.
_PASSED = (("part", "binary"), ("total", "double"), ("held", "double"), ("leaked", "double"))


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of a block, the degrees of its pages with links by place, and where rank goes astray."""
    block, size, places, degrees, leaks, shares = 0, 0, [], [], [], []
    for batch in batches:
        pos, late, degree, astray = (batch[c].to_numpy(zero_copy_only=False) for c in ("pos", "late", "degree", "astray"))
        late = late.astype(bool)
        block, size = batch["block"][0].as_py(), size + len(pos)
        places.append(pos[~late].astype(np.int32))
        degrees.append(degree[~late].astype(np.float64))
        leaks.append(pos[astray > 0].astype("<i4"))
        shares.append(astray[astray > 0].astype("<f8"))
    ordered = np.ones(sum(map(len, places)))
    for at, degree in zip(places, degrees):
        ordered[at] = degree
    packed = {"degrees": ordered.astype("<f8"), "leaks": np.concatenate(leaks), "shares": np.concatenate(shares)}
    yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "size": [size], "active": [len(ordered)],
                                      **{c: bytes_of(v) for c, v in packed.items()}})


# Ranks of a block that become rows at once.
_ROWS = 100_000


def _ranks(alpha: float, n: int, step: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ranks of a block: what each link gets, packed, with the totals for the next round, or rows at the end."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sizes, packed, got, total, held, leaked = 0, {}, {}, None, 1.0, [], []
        for batch in batches:
            for r in range(batch.num_rows):
                block = batch["block"][r].as_py()
                if batch["size"][r].is_valid:
                    sizes = {c: batch[c][r].as_py() for c in ("size", "active")}
                    packed = {c: np.frombuffer(batch[c][r].as_buffer(), t).copy() for c, t in (("degrees", "<f8"), ("leaks", "<i4"), ("shares", "<f8"))}
                elif batch["total"][r].is_valid:
                    total = batch["total"][r].as_py()
                    held.append(batch["held"][r].as_py())
                    leaked.append(batch["leaked"][r].as_py())
                elif batch["part"][r].is_valid:
                    part = np.frombuffer(batch["part"][r].as_buffer(), "<f8")
                    got = part.copy() if got is None else plus(got, part)
        size = sizes["size" if step == "end" else "active"]
        if step == "start":
            ranks = np.full(size, 1.0 / n)
        else:
            ranks = np.zeros(size) if got is None else got if len(got) == size else plus(np.zeros(size), got)
            ranks += (total - math.fsum(held)) / n
            ranks *= alpha
            ranks += (1 - alpha) / n
            total = alpha * (total - math.fsum(leaked)) + (1 - alpha)
        if step == "end":
            for first in range(0, size, _ROWS):
                some = ranks[first : first + _ROWS]
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(some), block, np.int32)),
                                                  "pos": pa.array(np.arange(first, first + len(some), dtype=np.int32)), "rank": pa.array(some)})
            return
        passed = {"total": [total], "held": [float(ranks.sum())], "leaked": [float(ranks[packed["leaks"]] @ packed["shares"])]}
        ranks /= packed["degrees"]
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "packed": bytes_of(ranks), **passed})

    return update


def _next_round(values: DataFrame, last: Written | None) -> tuple[DataFrame, Written]:
    """Write the values of a round; the table of the round before is no longer read by anything."""
    now = written(values, lean=True)
    if last is not None:
        last.release()
    return now.rows, now


def hits(
    graph_edges: DataFrame,
    iterations: int = 7,
    normalize: bool = False,
    vertices: DataFrame | None = None,
    checkpoint_every: int = 1,
) -> DataFrame:
    """Hub and authority scores after a fixed number of rounds: id, hub, authority.

    Both start at 1 and are computed from the previous round. Without `normalize` they grow from
    round to round; with it both vectors are scaled to unit length in every round.
    """
    merged = written(_merged_edges(graph_edges), lean=True)
    every = written(_vertices(merged.rows, vertices), lean=True)
    matrix = grid(_known(merged.rows), every.rows.withColumn("late", F.lit(False)))
    merged.release()
    every.release()
    placed = matrix.vertices.rows
    # Hubs are kind 0, authorities kind 1; either comes from the other.
    kinds = F.explode(F.array(F.lit(0), F.lit(1))).alias("kind")
    blocks = written(placed.groupBy("block").agg(F.count(F.lit(1)).alias("size")).select("block", "size", kinds))
    state = "block int, kind int, packed binary, square double"
    scores, last, lengths = blocks.rows.withColumn("part", F.lit(None).cast("binary")), None, None
    scores = scores.groupBy("block", "kind").applyInArrow(_scores(1.0), state)
    for i in range(iterations):
        got = products(matrix.cells.rows, matrix, scores.select("block", "kind", "packed"), lengths)
        rows = blocks.rows.unionByName(got.withColumn("kind", 1 - F.col("kind")), True)
        scores = rows.groupBy("block", "kind").applyInArrow(_scores(0.0), state)
        if normalize or (i + 1) % checkpoint_every == 0 or i + 1 == iterations:
            scores, last = _next_round(scores, last)
        if normalize:
            squares = scores.groupBy("kind").agg(F.sum("square").alias("square"))
            lengths = {r.kind: math.sqrt(r.square) for r in squares.collect()}
    ends = by_block(scores, _score_rows(lengths), "block int, pos int, hub double, authority double")
    out = written(placed.select("id", "block", "pos").join(ends, ["block", "pos"]).select("id", "hub", "authority"), lean=True)
    for table in (matrix, blocks, *([last] if last else [])):
        table.release()
    return out.rows


def _scores(start: float) -> Callable[[pa.Table], pa.Table]:
    """Packed scores of one kind of a block: `start` and what it received."""

    def update(rows: pa.Table) -> pa.Table:
        scores = start + summed(rows["part"], pc.max(rows["size"]).as_py())
        return pa.table({"block": rows["block"][:1], "kind": rows["kind"][:1],
                         "packed": pa.array([scores.astype("<f8").tobytes()], pa.binary()), "square": [float(scores @ scores)]})

    return update


def _score_rows(lengths: dict[int, float] | None) -> Callable[[pa.Table], pa.Table]:
    """Hub and authority of a block as rows, divided by their lengths."""

    def update(rows: pa.Table) -> pa.Table:
        found = {}
        for kind, packed in zip(rows["kind"].to_pylist(), rows["packed"]):
            scores = np.frombuffer(packed.as_buffer(), "<f8")
            if lengths:
                scores = scores / lengths[kind] if lengths[kind] else np.zeros(len(scores))
            found[kind] = scores
        size = len(found[0])
        return pa.table({"block": pa.array(np.full(size, rows["block"][0].as_py(), np.int32)),
                         "pos": pa.array(np.arange(size, dtype=np.int32)), "hub": pa.array(found[0]), "authority": pa.array(found[1])})

    return update


def of_type(scores: DataFrame, kind: str, name: str = "id") -> DataFrame:
    """Vertices of one type; the type stands in the second to seventh character of the name."""
    return scores.filter(F.substring(name, 2, 6) == kind)


def top_vertices(scores: DataFrame, score: str, k: int = 5, name: str = "id") -> DataFrame:
    best = top_rows(scores.select(name, score), [F.col(score).desc(), F.col(name).asc()], k)
    return best.orderBy(F.col(score).desc(), F.col(name).asc())


def top_n(scores: DataFrame, dictionary: DataFrame, n: int, score: str = "rank") -> DataFrame:
    """Best `n` vertices with their urls: url, score; equal scores all stay, ordered by id.

    `score` picks the kind of score when a table carries several.
    """
    best = top_rows(
        scores.select("id", F.col(score).alias("score")), [F.col("score").desc(), F.col("id").asc()], n
    )
    if n <= limit(scores.sparkSession, BROADCAST_ROWS):
        named = dictionary.join(F.broadcast(best), "id")
    else:
        named = dictionary.join(best, "id")
    return named.select("url", "score").orderBy(F.col("score").desc(), F.col("url").asc())
