"""Queries on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from irspark.llm import topk
from irspark.llm.registry import query, table

TOP_SQL = """
WITH usable AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query(TOP_SQL)
def op4_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best rows for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"), 5)
