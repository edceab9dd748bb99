"""Row numbers, ranks, running sums and top-k without sending a large group to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from irspark.plans.limits import ROWS_PER_TASK, TOP_K_ROWS, limit
from irspark.plans.lineage import materialize
from irspark.plans.skew import hot_keys

# monotonically_increasing_id() keeps the partition number above this bit and the row below it.
_ROW_BITS = 33


def row_index(df: DataFrame, order: Sequence[Column], name: str = "row_idx") -> DataFrame:
    """Add a dense 0-based index over the whole table in the given total order.

    Rows are range-partitioned and sorted, every partition numbers its own rows, and the
    partition sizes (one row per partition) are summed up to offsets.
    """
    numbered = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    sizes = numbered.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        numbered.withColumn("_pid", part)
        .join(F.broadcast(offsets), "_pid")
        .withColumn(name, local + F.col("_off"))
        .drop("_pid", "_off", "_mid")
    )


def has_large_group(df: DataFrame, by: Sequence[str]) -> bool:
    """Whether some group exceeds the rows one task may sort."""
    return not by or not hot_keys(df, by).isEmpty()


def prefix_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Add inclusive running sums per group in a total order.

    Small groups use one window. If any group is large, rows are range-partitioned by group and
    order, summed inside each (group, partition) and shifted by the sums of the partitions
    before it. Only groups that cross a partition border need a shift, and there are at most as
    many of those as partitions.
    """
    by = list(by)
    if not has_large_group(df, by):
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(v).over(w).alias(k) for k, v in sums.items()])
    keys = [F.col(c) for c in by]
    placed = materialize(
        df.repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id())
    )
    totals = placed.groupBy(*by, "_pid").agg(*[F.sum(v).alias(f"_t_{k}") for k, v in sums.items()])
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_pid", *[F.sum(f"_t_{k}").over(before).alias(f"_o_{k}") for k in sums]
    ).filter(F.coalesce(*[F.col(f"_o_{k}") for k in sums]).isNotNull())
    local = (
        Window.partitionBy(*by, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = placed.select("*", *[F.sum(v).over(local).alias(k) for k, v in sums.items()])
    renamed = offsets.select(
        F.col("_pid").alias("_opid"),
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[f"_o_{k}" for k in sums],
    )
    same = F.col("_pid") == F.col("_opid")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    shifted = summed.join(F.broadcast(renamed), same, "left")
    plain = [c for c in df.columns if c not in sums]
    return shifted.select(
        *plain, *[(F.col(k) + F.coalesce(F.col(f"_o_{k}"), F.lit(0))).alias(k) for k in sums]
    )


def rank_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank"
) -> DataFrame:
    """Add the 1-based position of every row in its group, in a total order."""
    if not has_large_group(df, by):
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    return prefix_sum(df, by, order, {name: F.lit(1).cast("bigint")})


def top_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """Best `k` rows of every group.

    The filter on row_number lets Spark cut every input partition to k rows per group before
    the shuffle, so a hot group costs k rows per task. Larger k goes through full ranks.
    """
    threshold = int(
        df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    )
    if k <= threshold:
        w = Window.partitionBy(*by).orderBy(*order)
        ranked = df.withColumn(name, F.row_number().over(w).cast("bigint"))
    else:
        ranked = rank_within(df, by, order, name)
    return ranked.filter(F.col(name) <= k)


def top_rows(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """Best `k` rows of the table; a large `k` is cut by row index instead of in one task."""
    if k is None:
        return df
    if k <= limit(df.sparkSession, TOP_K_ROWS):
        return df.orderBy(*order).limit(k)
    return row_index(df, order, "_top").filter(F.col("_top") < k).drop("_top")


def rows_per_task(df: DataFrame) -> int:
    return limit(df.sparkSession, ROWS_PER_TASK)
