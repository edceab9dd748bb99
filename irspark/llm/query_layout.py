"""Queries on mixing and sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm import mixing, sharding
from irspark.llm.registry import query, table
from irspark.plans.lineage import materialize

WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0

# A full source has its limit; the others share the rest. Each step fills the sources that are
# above, so as many steps as there are sources are enough; sources of the tables are 20.
MIX_SQL = """
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
sources AS (SELECT source, sum(size)::DOUBLE AS s FROM rows_ GROUP BY source),
weighed AS (
  SELECT source, s, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sources),
steps AS (
  SELECT 0 AS step, source, s, w, false AS is_full, 1.5 * sum(s) OVER () AS budget FROM weighed
  UNION ALL
  SELECT step + 1, source, s, w, is_full OR w * level >= 2 * s, budget FROM (
    SELECT *, (budget - coalesce(sum(2 * s) FILTER (is_full) OVER (), 0)) / sum(w) FILTER (NOT is_full) OVER () AS level
    FROM steps) WHERE step < 40),
target AS (
  SELECT source, s, CASE WHEN is_full THEN 2 * s ELSE w * (budget - coalesce(sum(2 * s) FILTER (is_full) OVER (), 0))
    / sum(w) FILTER (NOT is_full) OVER () END AS target FROM steps WHERE step = 40),
plan AS (
  SELECT *, floor(floor(target) / greatest(s, 1)) AS epochs,
    floor(target) - floor(floor(target) / greatest(s, 1)) * s AS rest FROM target),
placed AS (
  SELECT r.doc_id, r.size, p.s, p.target, p.epochs, p.rest,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY r.k, r.doc_id ROWS UNBOUNDED PRECEDING) - r.size AS before_
  FROM rows_ r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
  (epochs * size + greatest(0, least(size, rest - before_)))::BIGINT AS taken FROM placed
"""


@query(MIX_SQL)
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in the mix. The words are counted once, in a narrow table."""
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", mixing.words(docs["text"]).alias("size")))
    return mixing.mix(sized, WEIGHTS, SHARE, MOST, sized["size"]).drop("source")


@query()
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; DuckDB has no crc32, so tests compare with Python."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))
