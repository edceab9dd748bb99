"""Queries on quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from irspark.llm import quality
from irspark.llm.registry import query, table


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; tests compare with plain Python."""
    return quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
