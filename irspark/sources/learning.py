"""Ranking matrices, feature tables and boosted models on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.plans.ordering import row_index
from irspark.sources.relevance import file_rows


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: label, features, query id. Rows get their place in the file as doc_id."""
    raw = spark.read.csv(path, header=True)
    label, *features, query = raw.columns
    rows = raw.select(
        F.col(label).cast("double").alias("label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("features"),
        F.col(query).cast("bigint").alias("query_id"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    return row_index(rows, file_rows(rows), "doc_id").drop("_file", "_start", "_mid")


def write_table(df: DataFrame, path: str) -> None:
    """Vocabulary, weights, scores and other feature tables."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
