"""Exact top-k search by inner product: aggregation of sorted lists without random access.

Vectors are cut into blocks, and a block holds one sorted list per component. For a query, every
list gives its contributions in falling order, from its upper or its lower end by the sign of the
query's component. Lists are read to the same depth, which doubles in each round. Of each vector
the parts that were read are known; a part that was not is at most the last one read from its
list (upper bound) and at least the smallest one (lower bound). Reading stops when few vectors,
and none that is unseen, can have an upper bound that reaches the k-th best lower bound; the few
are then resolved with their whole vectors. Scores of the leaders are resolved in each round, as
the exact score is the best lower bound. The bounds of all queries of a block are summed at once:
what a list has shown beyond its last reading, times the queries' components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.ordering import top_within

# Vectors and queries in one block; a task holds one of each at a time.
_VECTORS, _QUERIES = 4_096, 512
# Reading starts with this part of a list; up to this part of a block is resolved at once.
_FIRST, _RESOLVED = 4, 16
# Sums below this bound are exact in doubles.
_EXACT = 2.0**52


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, in doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    """Whether a vector has components, and all of them are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


class Lists:
    """Sorted lists of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.exact = self.vectors.astype(np.float64)
        self.sorted = np.sort(self.exact, axis=0)
        self.largest = float(np.abs(self.exact).max(initial=0))

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the k best vectors with another id, ties to the smaller id."""
        may = self.ids[None, :] != query_ids[:, None]
        size = queries.shape[1] * self.largest * float(np.abs(queries).max(initial=0))
        bounded = size < _EXACT and len(self.ids) > k + 1
        reaches = self._reaching(queries.astype(np.float64), k, may) if bounded else may
        out = []
        for i, query in enumerate(queries):
            rows = np.flatnonzero(reaches[i])
            if bounded:
                scores = (self.exact[rows] @ query.astype(np.float64)).astype(np.int64)
            else:
                scores = self.vectors[rows] @ query
            first = np.lexsort((self.ids[rows], -scores))[:k]
            out.append((self.ids[rows][first], scores[first]))
        return out

    def _reaching(self, queries: np.ndarray, k: int, may: np.ndarray) -> np.ndarray:
        """Per query and vector: whether the upper bound reaches the k-th best lower bound."""
        n = len(self.ids)
        reaches, waiting = np.zeros_like(may), np.arange(len(queries))
        lower = np.full(len(queries), -np.inf)
        depth = max(1, n // _FIRST)
        while True:
            first, last = self.sorted[n - depth], self.sorted[depth - 1]
            # What has been read from the upper and the lower ends, beyond the last ones read.
            upper_parts = np.maximum(self.exact - first, 0)
            lower_parts = np.minimum(self.exact - last, 0)
            q, own = queries[waiting], ~may[waiting]
            plus, minus = np.maximum(q, 0), np.minimum(q, 0)
            upper = plus @ upper_parts.T
            upper += minus @ lower_parts.T
            upper += (plus @ first + minus @ last)[:, None]
            upper[own] = -np.inf
            # One leader more than k, as the query's own vector may be among them.
            leaders = np.argpartition(upper, n - k - 1, axis=1)[:, n - k - 1 :]
            scores = np.einsum("qld,qd->ql", self.exact[leaders], q)
            scores[np.take_along_axis(own, leaders, axis=1)] = -np.inf
            lower[waiting] = np.maximum(lower[waiting], np.sort(scores, axis=1)[:, 1])
            found = (upper >= lower[waiting, None]) & ~own
            done = (found.sum(axis=1) <= max(4 * k, n // _RESOLVED)) | (depth == n)
            reaches[waiting[done]] = found[done]
            waiting = waiting[~done]
            if not len(waiting):
                return reaches
            depth = min(n, 2 * depth)


def _unpack(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix from one packed block."""
    ids = rows.field(0).to_numpy(zero_copy_only=False)
    return ids, rows.field(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def search(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id",
           vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The k best rows of `vectors` for each row of `queries`: query_id, rank, vec_id, score.

    Every block of queries meets every block of vectors in one task; a query keeps k rows of each
    block, so what is shuffled after is bounded by queries times blocks. The two meet in a merge
    join: queries are repeated once a block, which no estimate sees, so they must not be broadcast.
    Rows of one block come one after another and share its sorted lists. Vectors that are null,
    empty, or hold a null or not finite component take no part, nor do rows without an id; a
    vector of another length than the query's is no candidate. Equal rows count once. Rows with
    the query's id are the query's own; of several vectors with one id the smallest one asks.
    Products are computed in 64-bit integers. Empty tables give an empty result.
    """

    def given(df: DataFrame) -> DataFrame:
        held = df.select(df[vec_id].cast("bigint").alias("id"), df[vector].alias("v"))
        held = held.filter(F.col("id").isNotNull() & usable(F.col("v")))
        return held.select("id", scaled(F.col("v"), scale).alias("v"), F.size("v").alias("dim"))

    base = materialize(given(vectors).distinct())
    asking = materialize(given(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))
    blocks = max(1, -(-base.count() // _VECTORS))
    groups = max(1, -(-asking.count() // _QUERIES))
    # Blocks are the work: with fewer tasks than blocks, several wait for one task.
    tasks = max(blocks, int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def packed(df: DataFrame, n: int, key: str, name: str) -> DataFrame:
        placed = df.withColumn(key, F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int"))
        placed = placed.repartition(min(n, tasks) if key == "group" else tasks, "dim", key)
        return placed.groupBy("dim", key).agg(F.collect_list(F.struct("id", "v")).alias(name))

    # A stated set of queries against all rows, block by block: one row per pair of blocks.
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asked = packed(asking, groups, "group", "queries").select("dim", "queries", each)
    pairs = packed(base, blocks, "block", "vectors").hint("merge").join(asked, ["dim", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lists = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column(2)[row].as_py(), batch.column(3)[row].as_py()
                if block != held:
                    held, lists = block, Lists(*_unpack(batch.column(0)[row].values))
                ids, asked = _unpack(batch.column(1)[row].values)
                found = lists.best(ids, asked, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, [len(f[0]) for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[1] for f in found]), pa.int64())],
                    names=["query_id", "vec_id", "score"])

    found = pairs.select("vectors", "queries", "dim", "block").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    best = top_within(found, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
