"""Sums over all pairs of a group, computed block against block.

Rows of a group are cut into blocks of bounded size. Every pair of blocks is one row holding two
short arrays, so a large group spreads over many tasks and no row per pair is ever made.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.plans.limits import PAIR_BLOCK, limit
from irspark.plans.lineage import materialize
from irspark.plans.skew import lookup_join


def pairwise_sum(
    cells: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    term: Callable[[Column, Column], Column],
    name: str,
    largest: int | None = None,
    only: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """For every cell i: the sum of term(i, j) over all cells j of its group.

    `cells` has the group columns and the `values`; `term` gets two structs of the values.
    `largest` is a bound for the cells of a group, when one is known; `only` picks the cells that
    get a sum, by default all. Returns by, values, `name`.
    """
    by, values = list(by), list(values)
    rows = limit(cells.sparkSession, PAIR_BLOCK)
    cells = cells.select(*by, *values)
    listed = F.sort_array(F.collect_list(F.struct(*values))).alias("_cells")
    if largest is not None and largest <= rows:
        # Every group is one block and meets only itself.
        pairs = cells.groupBy(*by).agg(listed).withColumn("_mine", F.col("_cells"))
    else:
        pairs = _block_pairs(cells, by, values, listed, rows)
    summed = F.transform(
        F.filter("_mine", only) if only else F.col("_mine"),
        lambda i: F.struct(
            i.alias("cell"),
            F.aggregate("_cells", F.lit(0.0), lambda acc, j: acc + term(i, j)).alias("part"),
        ),
    )
    return (
        pairs.select(*by, F.explode(summed).alias("s"))
        .groupBy(*by, *[F.col(f"s.cell.{v}").alias(v) for v in values])
        .agg(F.sum("s.part").alias(name))
    )


def _block_pairs(
    cells: DataFrame, by: list[str], values: list[str], listed: Column, rows: int
) -> DataFrame:
    """All pairs of blocks of a group: by, _mine, _cells."""
    counts = cells.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_blocks"))
    # Only groups of several blocks are listed, so this table is `rows` times smaller than cells.
    wide = materialize(counts.filter(F.col("_blocks") > 1))
    number = F.coalesce(F.col("_blocks"), F.lit(1))
    block = F.pmod(F.xxhash64(*values), number.cast("bigint")).cast("int")
    blocks = (
        lookup_join(cells, wide, by, "left")
        .groupBy(*by, number.alias("_blocks"), block.alias("_block"))
        .agg(listed)
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block")
    left = blocks.select(*by, F.col("_cells").alias("_mine"), partner)
    return left.join(blocks.select(*by, "_block", "_cells"), [*by, "_block"])
