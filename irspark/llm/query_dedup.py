"""Queries on duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm import lines, minhash
from irspark.llm.registry import query, table


@query()
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by two-word shingles; tests compare with all pairs."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query()
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents with one line kept per component; tests compare with all pairs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = lines.without_lines(docs, lines.repeated_lines(docs))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))
