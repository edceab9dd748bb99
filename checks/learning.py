"""Learning to rank over the embeddings: ids make queries, labels are graded, features are vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, r6, table
from irspark.operators import ltr
from irspark.sources.relevance import ranking_rows

K = 5


def matrix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        (F.col("vec_id") % 20).alias("query_id"),
        F.col("vec_id").alias("doc_id"),
        (F.col("label") % 5).cast("double").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.element_at("embedding", 1).cast("double").alias("score"),
    )


LTR_SQL = """
x AS (
  SELECT vec_id % 20 AS query_id, vec_id AS doc_id, CAST(label % 5 AS DOUBLE) AS label,
    CAST(embedding[1] AS DOUBLE) AS score FROM embeddings
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank,
    row_number() OVER (PARTITION BY query_id ORDER BY label DESC, doc_id) AS best FROM x
),
g AS (
  SELECT query_id,
    sum((2 ** label - 1) / log2(rank + 1)) FILTER (WHERE rank <= 5) AS dcg,
    sum(label / log2(rank + 1)) FILTER (WHERE rank <= 5) AS dcg_linear,
    sum((2 ** label - 1) / log2(best + 1)) FILTER (WHERE best <= 5) AS ideal
  FROM r GROUP BY 1
)"""


@check(f"WITH {LTR_SQL} SELECT query_id, round(dcg, 6) AS dcg, round(dcg_linear, 6) AS dcg_linear FROM g")
def dcg(spark: SparkSession, d: str) -> DataFrame:
    data = matrix(spark, d)
    linear = ltr.dcg(data, K, "linear").withColumnRenamed("dcg", "dcg_linear")
    return ltr.dcg(data, K).join(linear, "query_id").select(
        "query_id", r6("dcg").alias("dcg"), r6("dcg_linear").alias("dcg_linear")
    )


@check(f"WITH {LTR_SQL} SELECT query_id, round(CASE WHEN ideal <> 0 THEN dcg / ideal END, 6) AS ndcg FROM g")
def ndcg(spark: SparkSession, d: str) -> DataFrame:
    return ltr.ndcg(matrix(spark, d), K).withColumn("ndcg", r6("ndcg"))


@check(f"WITH {LTR_SQL} SELECT round(avg(CASE WHEN ideal <> 0 THEN dcg / ideal END), 6) AS avg_ndcg FROM g")
def avg_ndcg(spark: SparkSession, d: str) -> DataFrame:
    return ltr.average_ndcg(matrix(spark, d), K).withColumn("avg_ndcg", r6("avg_ndcg"))


@check(f"""
WITH {LTR_SQL}
SELECT a.query_id, a.doc_id AS doc_i, b.doc_id AS doc_j,
  round(abs((2 ** a.label - 2 ** b.label) * (1 / log2(b.rank + 1) - 1 / log2(a.rank + 1)))
    / CASE WHEN g.ideal <> 0 THEN g.ideal ELSE 1 END, 6) AS delta
FROM r a JOIN r b ON a.query_id = b.query_id JOIN g ON g.query_id = a.query_id
WHERE a.rank <= 5 OR b.rank <= 5
""")
def delta_ndcg(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that touch the best five; all others are 0."""
    return ltr.delta_ndcg(matrix(spark, d), K).withColumn("delta", r6("delta"))


@check(f"""
WITH {LTR_SQL}
SELECT count(*) AS pair_errors FROM x a JOIN x b ON a.query_id = b.query_id
WHERE (a.score <= b.score) = (a.label > b.label)
""")
def pair_errors(spark: SparkSession, d: str) -> DataFrame:
    return ltr.pair_errors(matrix(spark, d))


@check(f"""
WITH {LTR_SQL}
SELECT doc_id, query_id, CAST(dense_rank() OVER (PARTITION BY query_id ORDER BY label) * 5 AS DOUBLE) AS label FROM x
""")
def label_norm(spark: SparkSession, d: str) -> DataFrame:
    return ltr.normalize_labels(matrix(spark, d)).select("doc_id", "query_id", "label")


@check(f"""
WITH {LTR_SQL}
SELECT doc_id, CASE WHEN dense_rank() OVER (ORDER BY query_id) <=
  floor(0.2 * (SELECT count(DISTINCT query_id) FROM x)) THEN 'valid' ELSE 'train' END AS part FROM x
""")
def query_split(spark: SparkSession, d: str) -> DataFrame:
    return ltr.split_by_query(matrix(spark, d), 0.2).select("doc_id", "part")


@check(f"""
WITH {LTR_SQL}
SELECT a.doc_id, round(sum(sign(a.label - b.label) / (1 + exp((a.score - b.score) * sign(a.label - b.label)))), 6)
  AS lambda
FROM x a JOIN x b ON a.query_id = b.query_id GROUP BY 1
""")
def lambda_gradient(spark: SparkSession, d: str) -> DataFrame:
    return ltr.lambda_gradient(matrix(spark, d)).select("doc_id", r6("lambda").alias("lambda"))


@check(f"""
WITH {LTR_SQL}
SELECT a.doc_id, round(sum(sign(a.label - b.label) / (1 + exp((a.score - b.score) * sign(a.label - b.label)))
  * CASE WHEN a.rank <= 5 OR b.rank <= 5 THEN
      abs((2 ** a.label - 2 ** b.label) * (1 / log2(b.rank + 1) - 1 / log2(a.rank + 1)))
      / CASE WHEN g.ideal <> 0 THEN g.ideal ELSE 1 END ELSE 0 END), 6) AS lambda
FROM r a JOIN r b ON a.query_id = b.query_id JOIN g ON g.query_id = a.query_id GROUP BY 1
""")
def lambda_gradient_delta(spark: SparkSession, d: str) -> DataFrame:
    """Gradient weighted by the change of NDCG."""
    rows = ltr.lambda_gradient(matrix(spark, d), k_delta=K)
    return rows.select("doc_id", r6("lambda").alias("lambda"))


@check(f"""
WITH {LTR_SQL}
SELECT query_id AS "QueryId", doc_id AS "DocumentId",
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM x
""")
def ltr_submission(spark: SparkSession, d: str) -> DataFrame:
    return ranking_rows(ltr.submission(matrix(spark, d)))


def boosting_sql(rounds: int, rate: float, depth: int = 3) -> str:
    """Common tables of boosting with exact splits: rows `x`, gradients `lam0..`, scores `h0..`."""
    parts = ["""
raw AS (
  SELECT vec_id % 20 AS query_id, vec_id AS doc_id, CAST(label % 5 AS DOUBLE) AS label,
    embedding::DOUBLE[] AS features FROM embeddings
),
x AS MATERIALIZED (
  SELECT query_id, doc_id, features,
    CAST(dense_rank() OVER (PARTITION BY query_id ORDER BY label) * 5 AS DOUBLE) AS label,
    CASE WHEN dense_rank() OVER (ORDER BY query_id) <= floor(0.2 * (SELECT count(DISTINCT query_id) FROM raw))
      THEN 'valid' ELSE 'train' END AS part FROM raw
),
vals AS MATERIALIZED (
  SELECT doc_id, unnest(features) AS value, generate_subscripts(features, 1) - 1 AS feature FROM x
),
h0 AS (SELECT doc_id, 0.0::DOUBLE AS h FROM x)"""]
    for r in range(rounds):
        parts.append(f"""
lam{r} AS MATERIALIZED (
  SELECT a.doc_id, sum(sign(a.label - b.label) / (1 + exp((s.h - t.h) * sign(a.label - b.label)))) AS l
  FROM x a JOIN x b USING (query_id) JOIN h{r} s ON s.doc_id = a.doc_id JOIN h{r} t ON t.doc_id = b.doc_id
  WHERE a.part = 'train' GROUP BY 1
),
n{r}_0 AS (SELECT doc_id, 1 AS node FROM x)""")
        for k in range(depth):
            parts.append(f"""
run{r}_{k} AS (
  SELECT node, feature, value, lead(value) OVER w AS next, sum(s) OVER (w ROWS UNBOUNDED PRECEDING) AS sl,
    sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS nl, sum(s) OVER a AS s, sum(n) OVER a AS n
  FROM (SELECT node, feature, value, sum(l) AS s, count(*) AS n
        FROM lam{r} JOIN n{r}_{k} USING (doc_id) JOIN vals USING (doc_id) GROUP BY 1, 2, 3)
  WINDOW w AS (PARTITION BY node, feature ORDER BY value), a AS (PARTITION BY node, feature)
),
best{r}_{k} AS MATERIALIZED (
  SELECT node, feature, (value + next) / 2 AS threshold
  FROM (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) AS gain FROM run{r}_{k} WHERE next IS NOT NULL)
  WHERE gain - s * s / n > 1e-9
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 6) DESC, feature, value) = 1
),
n{r}_{k + 1} AS MATERIALIZED (
  SELECT c.doc_id, CASE WHEN b.node IS NULL THEN c.node WHEN v.value <= b.threshold THEN 2 * c.node
    ELSE 2 * c.node + 1 END AS node
  FROM n{r}_{k} c LEFT JOIN best{r}_{k} b ON b.node = c.node
  LEFT JOIN vals v ON v.doc_id = c.doc_id AND v.feature = b.feature
)""")
        parts.append(f"""
h{r + 1} AS MATERIALIZED (
  SELECT c.doc_id, h + {rate} * mean AS h FROM n{r}_{depth} c JOIN h{r} USING (doc_id)
  JOIN (SELECT node, avg(l) AS mean FROM lam{r} JOIN n{r}_{depth} USING (doc_id) GROUP BY 1) USING (node)
)""")
    return ",".join(parts)


def metrics_sql(rounds: int) -> str:
    one_round = """
SELECT {r}::INT AS iteration, max(errors) FILTER (part = 'train') AS errors_train,
  max(ndcg) FILTER (part = 'train') AS ndcg_train, max(errors) FILTER (part = 'valid') AS errors_valid,
  max(ndcg) FILTER (part = 'valid') AS ndcg_valid, (SELECT round(sqrt(sum(l * l)), 6) FROM lam{r}) AS gradient_norm
FROM (SELECT part, count(*) AS errors FROM s{n} a JOIN s{n} b USING (part, query_id)
      WHERE (a.h <= b.h) = (a.label > b.label) GROUP BY 1)
JOIN (SELECT part, round(avg(CASE WHEN ideal <> 0 THEN dcg / ideal END), 6) AS ndcg FROM (
        SELECT part, query_id, sum((2 ** label - 1) / log2(rank + 1)) FILTER (rank <= 5) AS dcg,
          sum((2 ** label - 1) / log2(best + 1)) FILTER (best <= 5) AS ideal
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY h DESC, doc_id) AS rank,
                row_number() OVER (PARTITION BY query_id ORDER BY label DESC, doc_id) AS best FROM s{n})
        GROUP BY 1, 2) GROUP BY 1) USING (part)"""
    scored = ",".join(
        f" s{n} AS MATERIALIZED (SELECT part, query_id, x.doc_id, label, round(h, 12) AS h FROM x JOIN h{n} USING (doc_id))"
        for n in range(1, rounds + 1)
    )
    return scored + " UNION ALL ".join(one_round.format(r=r, n=r + 1) for r in range(rounds))


@check(f"""
WITH {boosting_sql(3, 0.1)}
SELECT query_id, x.doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(h, 9) DESC, x.doc_id) AS rank
FROM x JOIN h3 USING (doc_id)
""")
def lambdarank_fit(spark: SparkSession, d: str) -> DataFrame:
    """Three boosting rounds with exact splits, then the ranking by predicted score."""
    data = matrix(spark, d).drop("score")
    model, _ = ltr.fit(data, 3, learning_rate=0.1, metrics=False)
    return ltr.submission(ltr.predict(data, model))


@check(f"WITH {boosting_sql(2, 0.1)}, {metrics_sql(2)}")
def lambdarank_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Pair errors, NDCG and gradient length after every round."""
    _, history = ltr.fit(matrix(spark, d).drop("score"), 2, learning_rate=0.1)
    rows = spark.createDataFrame(
        [tuple(h.values()) for h in history],
        "iteration int, errors_train bigint, ndcg_train double, errors_valid bigint, "
        "ndcg_valid double, gradient_norm double",
    )
    return rows.withColumns({c: r6(c) for c in ("ndcg_train", "ndcg_valid", "gradient_norm")})
