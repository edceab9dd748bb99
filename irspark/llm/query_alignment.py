"""Queries on two tokenizers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from irspark.llm import alignment
from irspark.llm.registry import query, table


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers; no SQL encodes, so tests compare with brute force."""
    import public_tokenizers

    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf_dir, "documents"), *files, keep=["doc_id"])
