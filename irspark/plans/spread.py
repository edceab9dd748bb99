"""Giving CPU-heavy work enough tasks when the input has few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Distribute a freshly read table evenly if it has no more splits than there are cores.

    Small files are often one split, which one core would have to parse alone. Large tables have
    many more splits than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= cores else df
