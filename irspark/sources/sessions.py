"""Session logs and click matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.plans.ordering import row_index
from irspark.sources.relevance import file_rows, read_lines


def parse_sessions(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of two unused fields, query, region, n, n urls, clicked positions (1-based)."""
    parts = F.split(F.btrim(F.col(column), F.lit("\t\n\r ")), "\t")
    split = lines.withColumn("_p", parts).withColumn(
        "_n", F.get(F.col("_p"), F.lit(4)).try_cast("int")
    )
    clicks = F.slice("_p", F.col("_n") + 6, F.size("_p"))
    return split.select(
        *[c for c in lines.columns if c != column],
        F.get(F.col("_p"), F.lit(2)).alias("query"),
        F.get(F.col("_p"), F.lit(3)).alias("region"),
        F.slice("_p", F.lit(6), F.col("_n")).alias("urls"),
        F.transform(clicks, lambda c: c.cast("int")).alias("clicks"),
    )


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    return parse_sessions(spark.read.text(path))


def read_click_matrix(spark: SparkSession, path: str, split: str) -> DataFrame:
    """White-space separated 0/1 rows in file order: split, row_idx, clicks."""
    lines = read_lines(spark, path).filter(F.trim("value") != "")
    indexed = row_index(lines, file_rows(lines))
    cells = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    return indexed.select(
        F.lit(split).alias("split"),
        "row_idx",
        F.transform(cells, lambda c: c.cast("double").cast("int")).alias("clicks"),
    )
