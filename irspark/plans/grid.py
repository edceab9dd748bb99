"""A graph as a matrix in square cells, for rounds that multiply it with vectors of vertex values.

Vertices lie in blocks by hash, each with a place in its block; edges lie in the cell of their two
blocks and never move again. In a round the packed values of a block travel to its cells, and one
packed partial sum per cell travels back to a block, so a round moves 2 x side numbers a vertex.
A cell is stored as rows of _CHUNK edges that stream through the task that multiplies them, so a
task holds some rows, the values of a block and a partial sum, however many edges a cell has.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from irspark.plans.lineage import Written, written
from irspark.plans.limits import CELL_EDGES, ROWS_PER_TASK, limit
from irspark.plans.skew import skew_join

# Workers get the functions of this module with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this side, cells of CELL_EDGES edges give the cores work; beyond it they hold _FULL edges.
_SIDE, _FULL = 4, 24_000_000
# Vertices of a block, whose values are one row.
_BLOCK = 1_000_000
# Edges that are put together by cell, edges of a row of a cell, and edges that are multiplied, at once.
_PACK, _CHUNK, _AT_ONCE = 1_000_000, 500_000, 500_000
# Rows of a cell that are written and read at once.
_ROW_GROUP = {"parquet.block.row.count.limit": "2"}
_CELLS = "cell bigint, late boolean, src binary, dst binary, weight binary"


@dataclass(frozen=True)
class Grid:
    """cells: cell, late, src, dst, weight; vertices: those given with block and pos; cell -> its blocks."""

    cells: Written
    vertices: Written
    places: dict[int, tuple[int, int]]

    @property
    def buckets(self) -> int:
        return len(self.places)

    def release(self) -> None:
        self.cells.release()
        self.vertices.release()

    def frame(self, spark: SparkSession) -> DataFrame:
        """cell, src_block, dst_block: one row per cell."""
        return spark.createDataFrame([(c, *at) for c, at in self.places.items()], "cell bigint, src_block int, dst_block int")


def _even_keys(spark: SparkSession, n: int) -> list[int]:
    """One key for each of `n` hash buckets."""
    keys = spark.range(64 * n + 64).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("bucket")).agg(F.min("id").alias("id"))
    return [r.id for r in keys.orderBy("bucket").collect()]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task put together by cell, _PACK at a time; weights that are all 1 are left out."""

    def rows(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        cell, late, src, dst, weight = (t[c].to_numpy() for c in ("cell", "late", "src", "dst", "weight"))
        order = np.lexsort((late, cell))
        cell, late = cell[order], late[order]
        cuts = np.flatnonzero((np.diff(cell) != 0) | (late[1:] != late[:-1])) + 1
        for first, end in itertools.pairwise([0, *cuts.tolist(), len(cell)]):
            at = order[first:end]
            w = None if (weight[at] == 1).all() else weight[at].astype("<f8").tobytes()
            lists = [src[at].astype("<i4").tobytes(), dst[at].astype("<i4").tobytes(), w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([cell[first]], pa.int64()), pa.array([bool(late[first])]), *[pa.array([x], pa.binary()) for x in lists]],
                ["cell", "late", "src", "dst", "weight"],
            )

    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= _PACK:
            yield from rows(held)
            held, count = [], 0
    if count:
        yield from rows(held)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a cell put together to rows of about _CHUNK edges."""

    def row(key: tuple[int, bool], parts: list[tuple[bytes, bytes, bytes | None]]) -> pa.RecordBatch:
        src, dst = (b"".join(p[i] for p in parts) for i in (0, 1))
        weight = None
        if any(p[2] is not None for p in parts):
            weight = b"".join(np.ones(len(p[0]) // 4).astype("<f8").tobytes() if p[2] is None else p[2] for p in parts)
        values = [[key[0]], [key[1]], [src], [dst], [weight]]
        kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["cell", "late", "src", "dst", "weight"])

    held: dict[tuple[int, bool], list[tuple[bytes, bytes, bytes | None]]] = {}
    for batch in batches:
        for r in range(batch.num_rows):
            key = batch["cell"][r].as_py(), batch["late"][r].as_py()
            parts = held.setdefault(key, [])
            parts.append(tuple(batch[c][r].as_py() for c in ("src", "dst", "weight")))
            if sum(len(p[0]) for p in parts) >= 4 * _CHUNK:
                yield row(key, held.pop(key))
    for key in list(held):
        yield row(key, held.pop(key))


def stored(packed: DataFrame, buckets: int) -> Written:
    """Packed edges in long rows, one bucket for each cell."""
    rows = packed.repartition(buckets, "cell").mapInArrow(_gathered, _CELLS)
    return written(rows, ["cell"], buckets, lean=True, placed=True, options=_ROW_GROUP)


def grid(edges: DataFrame, vertices: DataFrame) -> Grid:
    """Place `edges` (src, dst, weight, no nulls) by `vertices` (id, out_n, in_n, late, ...).

    Vertices marked `late` have the last places of their block, and edges to them are stored apart.
    out_n and in_n count the edges.
    """
    spark = edges.sparkSession
    count, n = edges.count(), vertices.count()
    side = max(
        min(_SIDE, math.ceil(math.sqrt(count / limit(spark, CELL_EDGES)))),
        math.ceil(math.sqrt(count / _FULL)), math.ceil(n / _BLOCK), 1,
    )
    keys = _even_keys(spark, side * side)
    places = {k: divmod(i, side) for i, k in enumerate(keys)}
    # A block is bounded, so one task may sort it.
    order = Window.partitionBy("block").orderBy("late", "id")
    placed = written(
        vertices.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(side)).cast("int")).withColumn(
            "pos", F.row_number().over(order) - 1
        ),
        lean=True,
    )
    rows = limit(spark, ROWS_PER_TASK)

    def hot(end: str, edges_of: str) -> DataFrame:
        many = placed.rows.filter(F.col(edges_of) > rows)
        return many.select(F.col("id").alias(end), F.ceil(F.col(edges_of) / rows).cast("int").alias("_parts"))

    ends = placed.rows.select("id", "block", "pos", "late")
    sources = ends.drop("late").withColumnsRenamed({"id": "src", "block": "_i", "pos": "_a"})
    targets = ends.withColumnsRenamed({"id": "dst", "block": "_j", "pos": "_b"})
    numbered = skew_join(edges, sources, ["src"], salt_on=["dst"], heavy=hot("src", "out_n"))
    numbered = skew_join(numbered, targets, ["dst"], salt_on=["src"], heavy=hot("dst", "in_n"))
    cell = F.get(F.array(*[F.lit(k).cast("bigint") for k in keys]), F.col("_i") * side + F.col("_j"))
    packed = numbered.select(
        cell.alias("cell"), "late", F.col("_a").alias("src"), F.col("_b").alias("dst"), F.col("weight").cast("double").alias("weight")
    ).mapInArrow(_packed, _CELLS)
    return Grid(stored(packed, side * side), placed, places)


def products(cells: DataFrame, matrix: Grid, vectors: DataFrame, lengths: dict[int, float] | None = None) -> DataFrame:
    """Partial sums (block, kind, part) of the vectors block, kind, packed.

    Values of kind 0 go from sources to targets, those of kind 1 back. `lengths` divide values by kind.
    Rows of edges stream past the values of their cell; a task returns one sum per block and kind.
    """
    places = matrix.places
    frame = F.broadcast(matrix.frame(cells.sparkSession))
    wanted = F.when(F.col("kind") == 0, F.col("src_block")).otherwise(F.col("dst_block"))
    sent = vectors.join(frame, F.col("block") == wanted).select("cell", "kind", "packed").repartition(matrix.buckets, "cell")
    # One row per cell, built into the table that its rows of edges look up: nothing is sorted.
    values = sent.groupBy("cell").agg(*[F.max(F.when(F.col("kind") == k, F.col("packed"))).alias(f"values_{k}") for k in (0, 1)])

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                i, j = places[batch["cell"][r].as_py()]
                src, dst = (np.frombuffer(batch[c][r].as_buffer(), "<i4") for c in ("src", "dst"))
                weight = batch["weight"][r]
                weight = np.frombuffer(weight.as_buffer(), "<f8") if weight.is_valid else None
                for kind, of, to, block in ((0, src, dst, j), (1, dst, src, i)):
                    given = batch[f"values_{kind}"][r]
                    if not given.is_valid:
                        continue
                    given = np.frombuffer(given.as_buffer(), "<f8")
                    for first in range(0, len(of), _AT_ONCE):
                        some = slice(first, first + _AT_ONCE)
                        v = given[of[some]]
                        if lengths is not None and kind in lengths:
                            v = v / lengths[kind] if lengths[kind] else np.zeros(len(v))
                        got = np.bincount(to[some], weights=v if weight is None else v * weight[some])
                        out[block, kind] = plus(out.get((block, kind)), got)
            del batch
        while out:
            (block, kind), v = out.popitem()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([kind], pa.int32()), bytes_of(v)], ["block", "kind", "part"])

    met = cells.select("cell", "src", "dst", "weight").join(values.hint("shuffle_hash"), "cell")
    return met.mapInArrow(product, "block int, kind int, part binary")


def bytes_of(v: np.ndarray) -> pa.Array:
    """A column with the bytes of `v` as its only value, without a copy."""
    v = np.ascontiguousarray(v)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, v.nbytes], np.int32)), pa.py_buffer(v)])


def plus(total: np.ndarray | None, part: np.ndarray) -> np.ndarray:
    """Sum of two vectors, the shorter one continued with zeros; writes to `total` if that is long enough."""
    if total is None:
        return part
    if len(total) < len(part):
        total = np.concatenate([total, np.zeros(len(part) - len(total))])
    total[: len(part)] += part
    return total


def summed(parts: pa.ChunkedArray, size: int) -> np.ndarray:
    """Sum of packed partial sums, null ones left out."""
    out = np.zeros(size)
    for p in parts:
        if p.is_valid:
            v = np.frombuffer(p.as_buffer(), "<f8")
            out[: len(v)] += v
    return out


def by_block(rows: DataFrame, update: Callable, schema: str) -> DataFrame:
    """The rows of each block turned into others, as a table or batch by batch."""
    return rows.groupBy("block").applyInArrow(update, schema)
