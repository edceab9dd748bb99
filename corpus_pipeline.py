"""A training corpus from documents: five stages, each written and read again before the next.

quality   documents that the quality rules reject go
lines     repeated lines go but the first; every document stays with what is left of it
minhash   one document of each group of near duplicates stays
mix       sources are cut or repeated to their target weights; documents without a word left go
encode    token ids of each document, and the check of the decoded text

Stages handle null ids, texts and sources, repeated rows and empty tables as their operators do.
Where an operator needs a name for each row and doc_id is not unique, rows are numbered in a
written copy, so that a task that runs again sees the same numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm import bpe, lines, minhash, mixing, quality
from irspark.llm.query_layout import MOST, SHARE, WEIGHTS
from irspark.llm.query_tokens import vocabulary_path
from irspark.plans.lineage import checkpoint_dir, materialize
from irspark.plans.skew import lookup_join

# Every document stays, whatever share of its text is left: its other lines are no copies, and it
# may hold the first copy of a line that was cut elsewhere.
LEAST_KEPT_PERCENT = 0
_ROW = "_row"


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents and a column that names each row."""
    n, ids, distinct = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if n == ids == distinct:
        return docs, "doc_id"
    return materialize(docs.withColumn(_ROW, F.monotonically_increasing_id())), _ROW


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated lines; copies of documents are left to the next stage."""
    named, key = _named(docs)
    cleaned = lines.without_lines(named, lines.repeated_lines(named, key), key)
    n_chars = F.length("text").cast("bigint")
    return cleaned.select(*[F.coalesce(n_chars, F.lit(0).cast("bigint")).alias(c) if c == "n_chars" else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    named, key = _named(docs)
    found = materialize(minhash.near_duplicates(named, width=5, percent=80, doc_id=key))
    gone = materialize(found.filter("not kept").select(key).distinct().withColumn("_gone", F.lit(True)))
    return lookup_join(named, gone, [key], "left").filter("_gone is null").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one that is taken in part is written whole."""
    mixed = mixing.mix(docs, WEIGHTS, SHARE, MOST)
    # A document without words has no size, so the mix can't take it.
    times = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return mixed.withColumn("_times", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and hashes of the ids and of the decoded text."""
    return bpe.encode_decode(docs, vocabulary_path(), values=["token_ids"])


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("minhash", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]

# No SQL computes the stages; tests compare the result with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
