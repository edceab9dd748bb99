"""A/B comparison of click metrics: block means, pooled t-test, bootstrap.

Sessions are rows split, row_idx (dense per split), clicks (0/1 per position). A metric is a
Column over such a row; its mean over a block of consecutive sessions is one observation.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.plans.limits import DRAW_ROWS, limit
from irspark.plans.lineage import materialize
from irspark.plans.ordering import top_within

# Workers get the functions of this module with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Metric = Callable[[], Column]


def have_clicks() -> Column:
    """1 if the session has any click."""
    total = F.aggregate("clicks", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return (total > 0).cast("int")


def first_click() -> Column:
    """Click on the first position."""
    return F.get("clicks", F.lit(0))


def block_means(sessions: DataFrame, metric: Metric, count: int) -> DataFrame:
    """Mean of the metric per block of `count` consecutive sessions: split, block, value."""
    block = F.floor(F.col("row_idx") / count).cast("bigint")
    return (
        sessions.select("split", block.alias("block"), metric().alias("m"))
        .groupBy("split", "block")
        .agg(F.avg("m").alias("value"))
    )


def ctr(sessions: DataFrame, count: int = 1000) -> DataFrame:
    return block_means(sessions, have_clicks, count)


def clicks_at_1(sessions: DataFrame, count: int = 1000) -> DataFrame:
    return block_means(sessions, first_click, count)


def head(series: DataFrame, n: int = 10) -> DataFrame:
    """First `n` observations of every split."""
    return top_within(series, ["split"], [F.col("block").asc()], n).drop("rank")


def t_quantile(spark: SparkSession, probability: float, df: int) -> float:
    """Quantile of Student's distribution, from the mathematics library Spark ships with."""
    t = spark.sparkContext._jvm.org.apache.commons.math3.distribution.TDistribution(float(df))
    return t.inverseCumulativeProbability(float(probability))


def _moments(series: DataFrame, first: str, second: str, by: list[str]) -> DataFrame:
    """Size, mean and sample variance of both splits side by side, in one aggregate."""
    aggs = []
    for tag, split in (("x", first), ("y", second)):
        value = F.when(F.col("split") == split, F.col("value"))
        aggs += [
            F.count(value).alias(f"n_{tag}"),
            F.avg(value).alias(f"mean_{tag}"),
            F.var_samp(value).alias(f"var_{tag}"),
        ]
    return series.groupBy(*by).agg(*aggs) if by else series.agg(*aggs)


def _t_value() -> Column:
    m, n = F.col("n_x"), F.col("n_y")
    # A side of one block has no variance of its own.
    spread = [F.coalesce((k - 1) * F.col(v), F.lit(0.0)) for k, v in ((m, "var_x"), (n, "var_y"))]
    pooled = F.try_divide(spread[0] + spread[1], m + n - 2)
    difference = F.col("mean_x") - F.col("mean_y")
    return F.try_divide(difference, F.sqrt(pooled)) * F.sqrt(F.try_divide(m * n, m + n))


def _rejects(critical: float | None) -> Column:
    """0 or 1; without any variance, different means are rejected and equal ones are not."""
    beyond = F.abs(_t_value()) > F.lit(critical)
    return F.coalesce(beyond, F.col("mean_x") != F.col("mean_y"), F.lit(False)).cast("int")


def t_test(series: DataFrame, first: str, second: str, alpha: float = 0.05) -> DataFrame:
    """Pooled two-sample test of block means: one row with t_value, t_critical, rejected (0/1).

    Without any variance t_value is null, and different means are rejected; the same holds
    without a degree of freedom, where t_critical is null too.
    """
    moments = materialize(_moments(series, first, second, []))
    sizes = moments.select("n_x", "n_y").first()
    free = sizes.n_x + sizes.n_y - 2
    critical = t_quantile(series.sparkSession, 1 - alpha / 2, free) if free > 0 else None
    return (
        moments.withColumn("t_value", _t_value())
        .withColumn("t_critical", F.lit(critical).cast("double"))
        .withColumn("rejected", _rejects(critical))
    )


# Draws come from three steps of multiplication modulo a prime, each after folding the upper bits in.
_PRIME = 2_147_483_647
_STEPS = ((15, 48_271, 11), (13, 1_103_515_245, 17), (16, 668_265_261, 23))


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Scrambled whole numbers below 2^31 - 1."""
    y = numbers % _PRIME
    for shift, factor, plus in _STEPS:
        y = ((y ^ (y >> shift)) * factor + plus) % _PRIME
    return y


def _seeds(seed: str, split: str) -> list[int]:
    return [zlib.crc32(f"{seed}|{split}|{word}".encode()) % _PRIME for word in ("upper", "lower")]


def draw_index(seed: str, split: str, iteration: int, scrambled: np.ndarray, n: int) -> np.ndarray:
    """Repeatable indices in [0, n) of one resample, from the scrambled numbers of its draws.

    Two scrambled words make a fraction of 62 bits, so indices are uniform for n below 2^32.
    """
    upper, lower = (_mixed(scrambled ^ _mixed(np.int64(iteration + s))) for s in _seeds(seed, split))
    return (upper * n + lower * n // _PRIME) // _PRIME


def bootstrap(
    sessions: DataFrame,
    first: str,
    second: str,
    metric: Metric = have_clicks,
    count_iteration: int = 7500,
    size_sample: int = 50000,
    size_group: int = 1000,
    alpha: float = 0.05,
    seed: str = "0",
) -> DataFrame:
    """Share of resampled t-tests that reject: iterations, rejected, share.

    Metric values are packed into ranges of consecutive sessions. A range meets parts of the
    iterations, makes their draws where it lies and keeps those that fall into it, so no draw is
    ever moved: only sums per block are. A split without sessions gives no draws, and nothing is
    rejected; sessions whose metric is null or NaN count in no mean.
    """
    spark = sessions.sparkSession
    values = materialize(
        sessions.filter(F.col("split").isin(first, second)).select(
            "split", F.col("row_idx").cast("bigint").alias("row_idx"), metric().cast("double").alias("m")
        )
    )
    sizes = {r.split: r.n for r in values.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    series = resampled_means(values, sizes, count_iteration, size_sample, size_group, seed)
    blocks = -(-size_sample // size_group)
    critical = t_quantile(spark, 1 - alpha / 2, 2 * blocks - 2) if blocks > 1 else None
    tests = _moments(series, first, second, ["iteration"]).select(_rejects(critical).alias("r"))
    return tests.agg(
        F.count(F.lit(1)).alias("iterations"),
        F.sum("r").alias("rejected"),
        F.avg("r").alias("share"),
    )


def resampled_means(
    values: DataFrame, sizes: dict[str, int], iterations: int, sample: int, group: int, seed: str
) -> DataFrame:
    """Block means of all resamples of the rows split, row_idx, m: iteration, split, block, value."""
    spark = values.sparkSession
    length = limit(spark, DRAW_ROWS)
    in_order = F.sort_array(F.collect_list(F.struct("row_idx", "m")))
    packed = values.groupBy("split", F.expr(f"row_idx div {length}").alias("part")).agg(
        F.transform(in_order, lambda x: x["m"]).alias("values")
    )
    ranges = max(1, sum(-(-n // length) for n in sizes.values()))
    # Few ranges are repeated for parts of the iterations, so that all cores have work.
    chunks = max(1, min(iterations, -(-4 * spark.sparkContext.defaultParallelism // ranges)))
    placed = packed.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    ).repartition(ranges * chunks, "split", "part", "chunk")
    starts = np.arange(0, sample, group)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scrambled, block = _mixed(np.arange(sample)), np.arange(sample) // group
        for batch in batches:
            for row in range(batch.num_rows):
                split, part, chunk = (batch.column(c)[row].as_py() for c in ("split", "part", "chunk"))
                held = batch.column("values")[row].values.to_numpy(zero_copy_only=False)
                known = ~np.isnan(held)
                held = np.where(known, held, 0.0)
                for iteration in range(chunk, iterations, chunks):
                    at = draw_index(seed, split, iteration, scrambled, sizes[split]) - part * length
                    here = np.flatnonzero((at >= 0) & (at < len(held)))
                    sums = np.bincount(block[here], held[at[here]], len(starts))
                    counts = np.bincount(block[here], known[at[here]], len(starts)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(starts), iteration)), pa.array([split] * len(starts)),
                         pa.array(np.arange(len(starts))), pa.array(sums), pa.array(counts)],
                        names=["iteration", "split", "block", "total", "n"])

    drawn = placed.select("split", "part", "values", "chunk").mapInArrow(
        draw, "iteration bigint, split string, block bigint, total double, n bigint"
    )
    return drawn.groupBy("iteration", "split", "block").agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("value")
    )
