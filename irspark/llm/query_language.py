"""Queries on languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm import language
from irspark.llm.registry import query, table


@query()
def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from four fifths of the documents; tests measure the accuracy.

    A null id counts as an empty text here, whose remainder is 0, so its row is held out.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    docs = docs.withColumn("held_out", held_out)
    return language.predict(docs, language.fit(docs.filter("not held_out")), keep=["doc_id", "held_out"])
