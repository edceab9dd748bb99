"""Text relevance over documents: tokens, stems, TF-IDF, ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, r6, table, wide_table
from irspark.functions import text as T
from irspark.operators import fields, ranking, tfidf
from irspark.plans.lineage import checkpoint_dir, materialize
from irspark.plans.spread import spread
from irspark.sources import relevance as S
from irspark.sources import store

STOP = ["the", "of", "and", "de", "la", "que", "der", "die", "el", "et"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
# Latin letters written as Cyrillic ones, so that the stemmer has words to work on.
LATIN = "abcdefghijklmnoprstuvyzéèêçóíñäöü"
CYRILLIC = "абцдефгхийклмнопрстувызеиояюыщшьэ"


def documents(spark: SparkSession, d: str) -> DataFrame:
    return wide_table(spark, d, "documents").select("doc_id", "text")


def queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), F.lower("text").alias("query")
    )


def known_candidates(
    spark: SparkSession, d: str, name: str = "documents", key: str = "doc_id"
) -> DataFrame:
    """Every document is a candidate of one query."""
    n = table(spark, d, "benchmark").agg(F.count(F.lit(1))).scalar()
    return table(spark, d, name).select(
        F.pmod(F.col(key), n).cast("string").alias("query_id"), F.col(key).alias("doc_id")
    )


def candidates(spark: SparkSession, d: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """Candidates, and for each query one page that does not exist."""
    unknown = table(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        (F.col("item_id") + 1000000000).alias("doc_id"),
    )
    return known_candidates(spark, d, name, key).unionByName(unknown)


CANDIDATES_SQL = """
cand AS (
  SELECT CAST(doc_id % (SELECT count(*) FROM benchmark) AS VARCHAR) AS query_id, doc_id FROM documents
  UNION ALL
  SELECT CAST(item_id AS VARCHAR), item_id + 1000000000 FROM benchmark
),
qtok AS (
  SELECT CAST(item_id AS VARCHAR) AS query_id,
         unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS term
  FROM benchmark
)"""

TFIDF_SQL = r"""
tok AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
voc AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tf GROUP BY term),
idf AS (
  SELECT term, tf, df, ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM voc
),
raw AS (
  SELECT t.doc_id, t.term, t.tf, t.tf * i.idf AS raw FROM tf t JOIN idf i USING (term)
),
w AS (
  SELECT doc_id, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw
)"""

SCORES_SQL = """
hits AS (
  SELECT c.query_id, c.doc_id, sum(w.weight) AS score
  FROM cand c JOIN qtok q USING (query_id) JOIN w ON w.doc_id = c.doc_id AND w.term = q.term
  GROUP BY 1, 2
),
scored AS (
  SELECT c.query_id, c.doc_id,
         CASE WHEN d.doc_id IS NULL THEN NULL ELSE coalesce(h.score, 0) END AS score
  FROM cand c LEFT JOIN documents d ON d.doc_id = c.doc_id
  LEFT JOIN hits h ON h.query_id = c.query_id AND h.doc_id = c.doc_id
)"""


def document_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    rows = materialize(tfidf.sparse_rows(docs))
    weights = tfidf.transform(rows, tfidf.fit_idf(rows))
    return tfidf.score(queries(spark, d), candidates(spark, d), weights, docs)


@check(f"""
WITH {CANDIDATES_SQL}, {TFIDF_SQL}, {SCORES_SQL},
ranked AS (
  SELECT query_id, doc_id, score, row_number() OVER (
    PARTITION BY query_id ORDER BY round(score, 9) DESC NULLS LAST, doc_id) AS rank
  FROM scored
)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 10
""")
def tfidf_rank(spark: SparkSession, d: str) -> DataFrame:
    """Ten best documents per query: the whole chain from text to ranking."""
    ranked = ranking.rank_missing_last(document_scores(spark, d))
    return ranked.filter(F.col("rank") <= 10).select("query_id", "doc_id", r6("score").alias("score"), "rank")


@check(rf"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS t FROM documents)
""")
def tokens(spark: SparkSession, d: str) -> DataFrame:
    t = T.fold_tokens(F.col("text"))
    return documents(spark, d).select(
        "doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.md5(F.array_join(t, " ")).alias("tokens")
    )


@check(f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '{T.SOCIAL.replace("'", "''")}') AS t FROM documents)
""")
def tokens_social(spark: SparkSession, d: str) -> DataFrame:
    t = T.fold_tokens(F.col("text"), "social")
    return documents(spark, d).select(
        "doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.md5(F.array_join(t, " ")).alias("tokens")
    )


@check(rf"""
SELECT doc_id, md5(array_to_string(list_filter(
  regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda t: t NOT IN ({STOP_SQL})), ' ')) AS tokens
FROM documents
""")
def stop_words_removed(spark: SparkSession, d: str) -> DataFrame:
    t = T.remove_stop_words(T.fold_tokens(F.col("text")), STOP)
    return documents(spark, d).select("doc_id", F.md5(F.array_join(t, " ")).alias("tokens"))


def cyrillic_words(spark: SparkSession, d: str) -> DataFrame:
    text = F.translate(F.lower("text"), LATIN, CYRILLIC)
    words = documents(spark, d).select(F.explode(T.tokenize(text)).alias("word")).distinct()
    return spread(materialize(words))


STEM_SQL = rf"""
word AS (
  SELECT DISTINCT unnest(regexp_extract_all(translate(lower(text), '{LATIN}', '{CYRILLIC}'),
         '[\p{{L}}\p{{N}}_]+')) AS word FROM documents
),
s0 AS (SELECT word, regexp_extract(word, '^([^{T.VOWELS}]*[{T.VOWELS}])', 1) AS head FROM word),
s1 AS (SELECT *, substr(word, length(head) + 1) AS tail FROM s0),
s2 AS (
  SELECT *, regexp_matches(tail, '([ая]({T.GERUND_AFTER_A})|{T.GERUND})$') AS is_gerund,
         regexp_replace(tail, '(ся|сь)$', '') AS plain FROM s1
),
s3 AS (
  SELECT word, head, CASE
    WHEN is_gerund THEN regexp_replace(tail, '([ая])({T.GERUND_AFTER_A})$|({T.GERUND})$', '\1')
    WHEN regexp_matches(plain, '([ая]({T.PARTICIPLE_AFTER_A})|{T.PARTICIPLE})({T.ADJECTIVE})$')
      THEN regexp_replace(plain, '(([ая])({T.PARTICIPLE_AFTER_A})|({T.PARTICIPLE}))({T.ADJECTIVE})$', '\2')
    WHEN regexp_matches(plain, '({T.ADJECTIVE})$') THEN regexp_replace(plain, '({T.ADJECTIVE})$', '')
    WHEN regexp_matches(plain, '([ая]({T.VERB_AFTER_A})|{T.VERB})$')
      THEN regexp_replace(plain, '([ая])({T.VERB_AFTER_A})$|({T.VERB})$', '\1')
    ELSE regexp_replace(plain, '({T.NOUN})$', '') END AS tail
  FROM s2
),
s4 AS (SELECT word, head, regexp_replace(tail, 'и$', '') AS tail FROM s3),
s5 AS (
  SELECT word, head, CASE WHEN regexp_matches(tail, '(ость|ост)$') AND regexp_matches(head || tail,
    '^[^{T.VOWELS}]*[{T.VOWELS}]+[^{T.VOWELS}][^{T.VOWELS}]*[{T.VOWELS}]+[^{T.VOWELS}].*(ость|ост)$')
    THEN regexp_replace(tail, '(ость|ост)$', '') ELSE tail END AS tail
  FROM s4
),
s6 AS (
  SELECT word, head, CASE
    WHEN regexp_matches(tail, 'ейше?$')
      THEN regexp_replace(regexp_replace(tail, 'ейше?$', ''), 'нн$', 'н')
    WHEN regexp_matches(tail, 'нн$') THEN regexp_replace(tail, 'н$', '')
    ELSE regexp_replace(tail, 'ь$', '') END AS tail
  FROM s5
)"""


@check(f"""
WITH {STEM_SQL}
SELECT word, CASE WHEN head = '' OR NOT regexp_matches(word, '\\p{{Cyrillic}}') THEN word
  ELSE head || tail END AS stem FROM s6
""")
def stems(spark: SparkSession, d: str) -> DataFrame:
    return cyrillic_words(spark, d).select("word", T.stem_russian(F.col("word")).alias("stem"))


@check(r"""
SELECT doc_id, md5(array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]+'), ' ')) AS normal
FROM documents
""")
def normalized_documents(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", F.md5(T.normalize_text(F.col("text"))).alias("normal"))


@check(r"""
SELECT CAST(item_id AS VARCHAR) AS query_id,
       array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), ' ') AS query
FROM benchmark
""")
def normalized_queries(spark: SparkSession, d: str) -> DataFrame:
    return fields.normalize_queries(queries(spark, d))


@check(f"""
WITH {TFIDF_SQL} SELECT term, tf, df FROM voc ORDER BY tf DESC, term LIMIT 5000
""")
def tfidf_vocab(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary cap is the feature: the most frequent terms."""
    return tfidf.fit_vocabulary(documents(spark, d), 5000)


@check(rf"""
WITH stems AS (
  WITH {STEM_SQL} SELECT word AS term, CASE WHEN head = '' OR NOT regexp_matches(word, '\p{{Cyrillic}}')
    THEN word ELSE head || tail END AS stem FROM s6
),
stop AS (
  SELECT stem FROM stems
  WHERE term IN ({", ".join(f"translate('{w}', '{LATIN}', '{CYRILLIC}')" for w in STOP)})
),
tok AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(lower(text), '{LATIN}', '{CYRILLIC}'),
         '[\p{{L}}\p{{N}}_]+')) AS term FROM documents
)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM tok
WHERE term NOT IN (SELECT stem FROM stop) GROUP BY term
""")
def vocab_stemmed_stops(spark: SparkSession, d: str) -> DataFrame:
    """Vocabulary without the stems of the stop words."""
    text = F.translate(F.lower("text"), LATIN, CYRILLIC)
    docs = documents(spark, d).withColumn("text", text)
    stops = spark.createDataFrame([(w,) for w in STOP], "w string").select(
        T.stem_russian(F.translate("w", LATIN, CYRILLIC)).alias("w")
    )
    return tfidf.fit_vocabulary(docs, stop_words=[r.w for r in stops.collect()])


@check(f"WITH {TFIDF_SQL} SELECT term, df, round(idf, 6) AS idf FROM idf")
def tfidf_idf(spark: SparkSession, d: str) -> DataFrame:
    return tfidf.fit_idf(documents(spark, d)).select("term", "df", r6("idf").alias("idf"))


@check(f"WITH {TFIDF_SQL} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM w")
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    rows = materialize(tfidf.sparse_rows(docs))
    weights = tfidf.transform(rows, tfidf.fit_idf(rows))
    return weights.select("doc_id", "term", "tf", r6("weight").alias("weight"))


@check(f"""
WITH {CANDIDATES_SQL}, {TFIDF_SQL},
req AS (SELECT DISTINCT c.doc_id, q.term FROM cand c JOIN qtok q USING (query_id))
SELECT r.doc_id, r.term,
  CASE WHEN d.doc_id IS NULL THEN NULL ELSE round(coalesce(w.weight, 0), 6) END AS weight
FROM req r LEFT JOIN documents d ON d.doc_id = r.doc_id
LEFT JOIN w ON w.doc_id = r.doc_id AND w.term = r.term
""")
def tfidf_lookup(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    rows = materialize(tfidf.sparse_rows(docs))
    weights = tfidf.transform(rows, tfidf.fit_idf(rows))
    words = tfidf.query_tokens(queries(spark, d)).select("query_id", F.explode("tokens").alias("term"))
    asked = candidates(spark, d).join(words, "query_id").select("doc_id", "term").distinct()
    return tfidf.lookup(asked, weights, docs).select("doc_id", "term", r6("weight").alias("weight"))


@check(f"""
WITH {CANDIDATES_SQL}, {TFIDF_SQL}, {SCORES_SQL}
SELECT query_id, doc_id, round(score, 6) AS score FROM scored
""")
def tfidf_scores(spark: SparkSession, d: str) -> DataFrame:
    return document_scores(spark, d).select("query_id", "doc_id", r6("score").alias("score"))


@check(f"""
WITH {CANDIDATES_SQL}, {TFIDF_SQL}, {SCORES_SQL}
SELECT CAST(query_id AS BIGINT) AS "QueryId", doc_id AS "DocumentId", row_number() OVER (
  PARTITION BY query_id ORDER BY round(score, 9) DESC NULLS LAST, doc_id) AS rank
FROM scored
""")
def submission(spark: SparkSession, d: str) -> DataFrame:
    """Whole ranking, missing pages last, as submission rows."""
    return S.ranking_rows(ranking.rank_missing_last(document_scores(spark, d)))


@check("""
SELECT doc_id, length(text) AS n FROM (
  SELECT doc_id, text, sum(length(text)) OVER (ORDER BY doc_id) AS s FROM documents
) WHERE s - length(text) <= 1000000
""")
def corpus_cap(spark: SparkSession, d: str) -> DataFrame:
    """The character cap is the feature: documents in id order until it is passed."""
    kept = fields.corpus_sample(documents(spark, d), 1_000_000, [F.col("doc_id")])
    return kept.select("doc_id", F.length("text").cast("bigint").alias("n"))


@check("""
SELECT doc_id FROM (
  SELECT doc_id, length(text) AS n,
         sum(length(text)) OVER (ORDER BY md5('7' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS s
  FROM documents
) WHERE s - n <= 1000000
""")
def corpus_sample(spark: SparkSession, d: str) -> DataFrame:
    order = [fields.random_order(F.col("doc_id"), "7"), F.col("doc_id")]
    return fields.corpus_sample(documents(spark, d), 1_000_000, order).select("doc_id")


@check(r"""
SELECT doc_id, md5(regexp_replace(text, '\A[^\n]*\n?', '')) AS rest FROM documents
""")
def skip_first_line(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", F.md5(S.drop_first_line(F.col("text"))).alias("rest"))


@check("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def failed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a row in labels stand for pages without a parse."""
    return S.failed_pages(documents(spark, d).select("doc_id"), table(spark, d, "labels"))


@check("""
SELECT CAST(doc_id % (SELECT count(*) FROM benchmark) AS VARCHAR) AS query_id, doc_id,
       row_number() OVER (PARTITION BY doc_id % (SELECT count(*) FROM benchmark) ORDER BY doc_id) - 1 AS pos
FROM documents
""")
def candidates_by_query(spark: SparkSession, d: str) -> DataFrame:
    return S.candidates(known_candidates(spark, d), [F.col("doc_id").asc()])


@check("""
SELECT CAST(doc_id % (SELECT count(*) FROM benchmark) AS VARCHAR) AS query_id, doc_id FROM documents
UNION ALL
SELECT CAST(item_id AS VARCHAR), item_id + 1000000000 FROM benchmark
""")
def candidates_from_json(spark: SparkSession, d: str) -> DataFrame:
    lines = candidates(spark, d).select(
        F.to_json(F.create_map("query_id", F.array("doc_id"))).alias("value")
    )
    return S.candidates_from_json(lines, "value").select("query_id", "doc_id")


@check("""
SELECT CAST(doc_id % (SELECT count(*) FROM benchmark) AS VARCHAR) AS query_id, doc_id,
       row_number() OVER (PARTITION BY doc_id % (SELECT count(*) FROM benchmark) ORDER BY doc_id) - 1 AS pos
FROM documents
""")
def candidates_file(spark: SparkSession, d: str) -> DataFrame:
    """Lists of candidates written as JSON and read back with their places."""
    path = f"{checkpoint_dir(spark)}/candidates_{uuid.uuid4().hex}"
    S.write_candidates(candidates_by_query(spark, d), path)
    return S.read_candidates(spark, path)


@check(f"""
WITH {CANDIDATES_SQL}, {TFIDF_SQL}, {SCORES_SQL}
SELECT query_id, doc_id, round(score, 6) AS score FROM scored
""")
def stored_scores(spark: SparkSession, d: str) -> DataFrame:
    """Vocabulary and weights fitted, written as a version, and read again to score the candidates."""
    docs, folder = documents(spark, d), f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    rows = materialize(tfidf.sparse_rows(docs))
    idf = tfidf.fit_idf(rows)
    store.save(spark, folder, {"vocabulary": idf, "weights": tfidf.transform(rows, idf)})
    weights = store.load(spark, folder).tables["weights"]
    scored = tfidf.score(queries(spark, d), candidates(spark, d), weights, docs)
    return scored.select("query_id", "doc_id", r6("score").alias("score"))


@check(r"""
SELECT CAST(item_id AS VARCHAR) AS query_id, regexp_replace(text, '[\t\n\r]+', ' ', 'g') AS query FROM benchmark
""")
def queries_file(spark: SparkSession, d: str) -> DataFrame:
    """Queries written as lines of id and text, and read back."""
    path = f"{checkpoint_dir(spark)}/queries-{uuid.uuid4().hex}"
    flat = F.regexp_replace("text", r"[\t\n\r]+", " ")
    table(spark, d, "benchmark").select(F.concat_ws("\t", F.col("item_id").cast("string"), flat)).write.text(path)
    return S.read_queries(spark, path)


@check("""
SELECT page_id AS doc_id, url, 'pages/' || page_id || '.html' AS path FROM pages WHERE url IS NOT NULL AND url <> ''
""")
def urls_file(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of urls written as lines, and read back."""
    path = f"{checkpoint_dir(spark)}/urls-{uuid.uuid4().hex}"
    file = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html"))
    pages = table(spark, d, "pages").filter("url <> ''")
    pages.select(F.concat_ws("\t", F.col("page_id").cast("string"), "url", file)).write.text(path)
    return S.read_urls(spark, path)
