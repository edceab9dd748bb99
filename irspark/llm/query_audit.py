"""Queries that audit the corpus: divergence of its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from irspark.llm import divergence
from irspark.llm.registry import query, table

DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
words AS (SELECT row_no, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
spans AS (
  SELECT DISTINCT lang, source FROM docs),
full_counts AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM spans s JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
shares AS (
  SELECT *, 1 + (1000000000 * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS p FROM full_counts
  WINDOW g AS (PARTITION BY lang, source)),
lang_counts AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS q FROM lang_counts
  WINDOW g AS (PARTITION BY lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM spans a JOIN spans b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
top_terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((s.p - l.q) * (s.p - l.q) // l.q)::BIGINT AS value
  FROM shares s JOIN lang_shares l USING (lang, term) WHERE s.n > 0 AND s.p > l.q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM top_terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query(DIVERGENCE_SQL)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every language against each other and against the language."""
    return divergence.audit(table(spark, sf_dir, "documents"))
