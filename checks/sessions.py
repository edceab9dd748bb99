"""Click sessions from orders: A/B comparison and click model.

A session is an order, its results are the parts by line number (the largest part where a line
number repeats), a click is a returned line. The query is the order priority, the split the
parity of the customer.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, r6, table
from irspark.operators import abtest, clicks
from irspark.plans.lineage import checkpoint_dir
from irspark.plans.ordering import rank_within
from irspark.sources import sessions as S


def shown(spark: SparkSession, d: str) -> DataFrame:
    """One row per order: query, region, split, results (part, clicked) by position."""
    lines = table(spark, d, "lineitem")
    positions = lines.agg(F.max("l_linenumber")).first()[0]
    clicked = (F.col("l_returnflag") == "R").cast("int")

    def at(p: int, value) -> F.Column:
        return F.max(F.when(F.col("l_linenumber") == p, value))

    cells = lines.groupBy("l_orderkey").agg(
        *[
            F.struct(at(p, F.col("l_partkey")).alias("part"), at(p, clicked).alias("click")).alias(f"p{p}")
            for p in range(1, positions + 1)
        ]
    )
    results = F.filter(F.array(*[f"p{p}" for p in range(1, positions + 1)]), lambda c: c["part"].isNotNull())
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderpriority").alias("query"),
        F.col("o_orderstatus").alias("region"),
        F.when(F.col("o_custkey") % 2 == 0, "a").otherwise("b").alias("split"),
    )
    return cells.select("l_orderkey", results.alias("results")).join(orders, "l_orderkey").select(
        F.col("l_orderkey").alias("session_id"), "query", "region", "split", "results"
    )


def sessions(spark: SparkSession, d: str) -> DataFrame:
    urls = F.transform("results", lambda r: F.concat(F.lit("u"), r["part"].cast("string")))
    at = F.transform("results", lambda r, i: F.when(r["click"] == 1, i + 1))
    return shown(spark, d).select(
        "session_id", "query", "region", urls.alias("urls"), F.filter(at, lambda p: p.isNotNull()).alias("clicks")
    )


def matrix(spark: SparkSession, d: str) -> DataFrame:
    cells = shown(spark, d).select(
        "split", "session_id", F.transform("results", lambda r: r["click"]).alias("clicks")
    )
    ranked = rank_within(cells, ["split"], [F.col("session_id").asc()], "row_idx")
    return ranked.select("split", (F.col("row_idx") - 1).alias("row_idx"), "clicks")


SESSION_SQL = """
line AS (
  SELECT l_orderkey, l_linenumber, max(l_partkey) AS part, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS click
  FROM lineitem GROUP BY 1, 2
),
item AS (
  SELECT l_orderkey AS session_id, o_orderpriority AS query, o_orderstatus AS region,
    CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS split,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos, 'u' || part AS url, click
  FROM line JOIN orders ON o_orderkey = l_orderkey
),
ses AS (
  SELECT session_id, any_value(query) AS query, any_value(split) AS split, max(click) AS any_click,
    max(CASE WHEN pos = 1 THEN click END) AS first_click, max(CASE WHEN click = 1 THEN pos END) AS last_pos
  FROM item GROUP BY 1
),
mat AS MATERIALIZED (
  SELECT split, row_number() OVER (PARTITION BY split ORDER BY session_id) - 1 AS row_idx, any_click, first_click
  FROM ses
)"""
BLOCK = 100


def block_sql(column: str) -> str:
    return f"SELECT split, CAST(row_idx // {BLOCK} AS BIGINT) AS block, avg({column}) AS value FROM mat GROUP BY 1, 2"


@check(f"""
WITH {SESSION_SQL}
SELECT session_id, any_value(query) AS query, any_value(region) AS region, string_agg(url, ',' ORDER BY pos) AS urls,
  coalesce(string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE click = 1), '') AS clicks
FROM item GROUP BY session_id
""")
def session_parse(spark: SparkSession, d: str) -> DataFrame:
    """Sessions written as log lines and read back."""
    lines = sessions(spark, d).select(
        "session_id",
        F.concat_ws(
            "\t",
            F.lit("x"),
            F.lit("y"),
            "query",
            "region",
            F.size("urls").cast("string"),
            "urls",
            F.transform("clicks", lambda c: c.cast("string")),
        ).alias("value"),
    )
    return S.parse_sessions(lines).select(
        "session_id",
        "query",
        "region",
        F.array_join("urls", ",").alias("urls"),
        F.array_join(F.transform("clicks", lambda c: c.cast("string")), ",").alias("clicks"),
    )


@check(f"WITH {SESSION_SQL} SELECT split, row_idx, any_click AS clicked FROM mat")
def have_clicks(spark: SparkSession, d: str) -> DataFrame:
    return matrix(spark, d).select("split", "row_idx", abtest.have_clicks().alias("clicked"))


@check(f"WITH {SESSION_SQL}, s AS ({block_sql('any_click')}) SELECT split, block, round(value, 6) AS value FROM s")
def ctr(spark: SparkSession, d: str) -> DataFrame:
    return abtest.ctr(matrix(spark, d), BLOCK).withColumn("value", r6("value"))


@check(f"WITH {SESSION_SQL}, s AS ({block_sql('first_click')}) SELECT split, block, round(value, 6) AS value FROM s")
def clicks_at_1(spark: SparkSession, d: str) -> DataFrame:
    return abtest.clicks_at_1(matrix(spark, d), BLOCK).withColumn("value", r6("value"))


@check(f"""
WITH {SESSION_SQL}, s AS ({block_sql('any_click')})
SELECT split, block, round(value, 6) AS value FROM s WHERE block < 10
""")
def metric_head(spark: SparkSession, d: str) -> DataFrame:
    """First ten observations of every split."""
    series = abtest.ctr(matrix(spark, d), BLOCK)
    return abtest.head(series, 10).withColumn("value", r6("value"))


# Expansion of the 97.5% Student quantile in 1/df around the normal one (exact to 1e-6 here).
Z = 1.959963984540054


def critical_sql(df: str) -> str:
    return (
        f"({Z} + {(Z**3 + Z) / 4} / ({df}) + {(5 * Z**5 + 16 * Z**3 + 3 * Z) / 96} / ({df}) ** 2"
        f" + {(3 * Z**7 + 19 * Z**5 + 17 * Z**3 - 15 * Z) / 384} / ({df}) ** 3"
        f" + {(79 * Z**9 + 776 * Z**7 + 1482 * Z**5 - 1920 * Z**3 - 945 * Z) / 92160} / ({df}) ** 4)"
    )


def moments_sql(by: str) -> str:
    return f"""SELECT {by} count(*) FILTER (WHERE split = 'a') AS m, count(*) FILTER (WHERE split = 'b') AS n,
    avg(value) FILTER (WHERE split = 'a') AS ax, avg(value) FILTER (WHERE split = 'b') AS ay,
    var_samp(value) FILTER (WHERE split = 'a') AS vx, var_samp(value) FILTER (WHERE split = 'b') AS vy FROM s"""


T_SQL = "(ax - ay) / sqrt(((m - 1.0) * vx + (n - 1.0) * vy) / (m + n - 2.0)) * sqrt(m * n * 1.0 / (m + n))"


@check(f"""
WITH {SESSION_SQL}, s AS ({block_sql('any_click')}), q AS ({moments_sql('')})
SELECT m AS n_x, n AS n_y, round(ax, 6) AS mean_x, round(ay, 6) AS mean_y, round({T_SQL}, 6) AS t_value,
  round({critical_sql('m + n - 2')}, 4) AS t_critical,
  CASE WHEN abs({T_SQL}) > {critical_sql('m + n - 2')} THEN 1 ELSE 0 END AS rejected FROM q
""")
def t_test(spark: SparkSession, d: str) -> DataFrame:
    test = abtest.t_test(abtest.ctr(matrix(spark, d), BLOCK), "a", "b")
    return test.select(
        "n_x", "n_y", r6("mean_x").alias("mean_x"), r6("mean_y").alias("mean_y"),
        r6("t_value").alias("t_value"), F.round("t_critical", 4).alias("t_critical"), "rejected",
    )


# 1,000 resamples of 50,000 sessions, observed in blocks of 1,000.
ITERATIONS, SAMPLE, GROUP = 1_000, 50_000, 1_000
PRIME = 2_147_483_647


def mixed_sql(name: str, number: str) -> str:
    """Columns of the steps that scramble a number; the last one is `name`."""
    one, two = f"{name}_1", f"{name}_2"
    return (
        f"({number}) % {PRIME} AS {name}_0, "
        f"(xor({name}_0, {name}_0 >> 15) * 48271 + 11) % {PRIME} AS {one}, "
        f"(xor({one}, {one} >> 13) * 1103515245 + 17) % {PRIME} AS {two}, "
        f"(xor({two}, {two} >> 16) * 668265261 + 23) % {PRIME} AS {name}"
    )


def bootstrap_sql(column: str, seed: str) -> str:
    def start(word: str) -> str:
        a, b = (zlib.crc32(f"{seed}|{split}|{word}".encode()) % PRIME for split in "ab")
        return f"i + CASE WHEN split = 'a' THEN {a} ELSE {b} END"

    return f"""
WITH {SESSION_SQL},
size AS (SELECT split, count(*) AS n FROM mat GROUP BY 1),
iter AS (
  SELECT i, split, n, {mixed_sql('upper', start('upper'))}, {mixed_sql('lower', start('lower'))}
  FROM range({ITERATIONS}) i(i), size
),
nth AS (SELECT t, {mixed_sql('e', 't')} FROM range({SAMPLE}) t(t)),
draw AS (
  SELECT i AS iteration, split, t // {GROUP} AS block, {mixed_sql('x', 'xor(e, upper)')}, {mixed_sql('y', 'xor(e, lower)')},
    (x * n + y * n // {PRIME}) // {PRIME} AS row_idx
  FROM iter, nth
),
s AS (SELECT iteration, split, block, avg({column}) AS value FROM draw JOIN mat USING (split, row_idx) GROUP BY 1, 2, 3),
q AS ({moments_sql('iteration,')} GROUP BY iteration),
r AS (SELECT CASE WHEN abs({T_SQL}) > {critical_sql('m + n - 2')} THEN 1 ELSE 0 END AS r FROM q)
SELECT count(*) AS iterations, CAST(sum(r) AS BIGINT) AS rejected, round(avg(r), 6) AS share FROM r
"""


def _bootstrap(spark: SparkSession, d: str, metric: abtest.Metric, seed: str) -> DataFrame:
    share = abtest.bootstrap(matrix(spark, d), "a", "b", metric, ITERATIONS, SAMPLE, GROUP, seed=seed)
    return share.withColumn("share", r6("share"))


@check(bootstrap_sql("any_click", "3"))
def bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """Resampled tests of the share of sessions with a click."""
    return _bootstrap(spark, d, abtest.have_clicks, "3")


@check(bootstrap_sql("first_click", "4"))
def bootstrap_first(spark: SparkSession, d: str) -> DataFrame:
    """Resampled tests of clicks on the first position."""
    return _bootstrap(spark, d, abtest.first_click, "4")


DBN_SQL = f"""
{SESSION_SQL},
seen AS (SELECT i.query, i.url, i.click, i.pos = s.last_pos AS is_last FROM item i JOIN ses s USING (session_id)
  WHERE i.pos <= s.last_pos),
dbn AS (
  SELECT query, url, count(*) AS a_d, CAST(sum(click) AS BIGINT) AS a_n, count(*) FILTER (WHERE is_last) AS s_n
  FROM seen GROUP BY 1, 2
),
rel AS (SELECT *, (a_n + 1.0) / (a_d + 2) * (s_n + 1) / (a_n + 2) AS rel FROM dbn)"""


@check(f"WITH {DBN_SQL} SELECT query, url, a_d, a_n, s_n FROM dbn")
def dbn_counts(spark: SparkSession, d: str) -> DataFrame:
    return clicks.dbn_counts(sessions(spark, d))


@check(f"WITH {DBN_SQL} SELECT query, url, round(rel, 6) AS rel FROM rel")
def dbn_rel(spark: SparkSession, d: str) -> DataFrame:
    return clicks.dbn(sessions(spark, d)).select("query", "url", r6("rel").alias("rel"))


@check(f"WITH {DBN_SQL} SELECT url, round(rel, 6) AS rel FROM rel WHERE query = '1-URGENT'")
def dbn_top(spark: SparkSession, d: str) -> DataFrame:
    best = clicks.top_for_query(clicks.dbn(sessions(spark, d)), "1-URGENT")
    return best.select("url", r6("rel").alias("rel"))


@check(f"""
WITH {SESSION_SQL},
line_of AS (SELECT session_id, string_agg(CAST(click AS VARCHAR), ',' ORDER BY pos) AS clicks FROM item GROUP BY 1)
SELECT split, row_number() OVER (ORDER BY session_id) - 1 AS row_idx, clicks
FROM ses JOIN line_of USING (session_id) WHERE split = 'a'
""")
def click_matrix_file(spark: SparkSession, d: str) -> DataFrame:
    """Clicks of one split written as a matrix of text, and read back in the order of its lines."""
    path = f"{checkpoint_dir(spark)}/clicks-{uuid.uuid4().hex}"
    cells = F.array_join(F.transform("clicks", lambda c: F.format_string("%d.0", c)), "  ")
    lines = matrix(spark, d).filter("split = 'a'").orderBy("row_idx").select(cells)
    lines.write.text(path)
    read = S.read_click_matrix(spark, path, "a")
    return read.withColumn("clicks", F.array_join(F.transform("clicks", lambda c: c.cast("string")), ","))
