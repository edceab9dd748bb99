"""PageRank, HITS and best vertices, on the links of pages and on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.pages import GRAPH_SQL, NUMBERED_SQL, pages
from checks.registry import check, r6, table
from irspark.operators import graph
from irspark.sources import graph as GS

# Rounds of PageRank and of HITS as the original programs make them.
ROUNDS = 50
HITS_ROUNDS = 7


def trade_edges(spark: SparkSession, d: str) -> DataFrame:
    """Every line links its part to the supplier; accepted lines link back, returned ones link the
    supplier to the customer. Customers link nowhere."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    part, supplier = F.col("l_partkey") * 4, F.col("l_suppkey") * 4 + 1
    out = lines.select(part.alias("src"), supplier.alias("dst"))
    back = lines.filter(F.col("l_returnflag") == "A").select(supplier.alias("src"), part.alias("dst"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    sink = (
        lines.filter(F.col("l_returnflag") == "R")
        .join(orders, "l_orderkey")
        .select(supplier.alias("src"), (F.col("o_custkey") * 4 + 2).alias("dst"))
    )
    return out.unionByName(back).unionByName(sink)


TRADE_SQL = """
e0 AS (
  SELECT l_partkey * 4 AS src, l_suppkey * 4 + 1 AS dst FROM lineitem
  UNION ALL SELECT l_suppkey * 4 + 1, l_partkey * 4 FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL SELECT l_suppkey * 4 + 1, o_custkey * 4 + 2 FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R'
),
e AS (SELECT src, dst, count(*) AS times FROM e0 GROUP BY 1, 2)"""

PAGE_EDGES_SQL = f"""
{GRAPH_SQL},
e AS (SELECT url AS src, link AS dst, times FROM merged WHERE link IS NOT NULL)"""


def pagerank_sql(edges: str, alpha: float = 0.85, rounds: int = ROUNDS) -> str:
    """PageRank with one table expression per round, over table e."""
    steps = [
        "v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)",
        "deg AS MATERIALIZED (SELECT src AS id, sum(times) AS degree FROM e GROUP BY 1)",
        "n AS (SELECT count(*) AS n FROM v)",
        "r0 AS (SELECT id, 1.0 / n AS rank FROM v, n)",
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""r{i} AS MATERIALIZED (
  SELECT v.id, {alpha} * (coalesce(g.s, 0) + l.lost / n.n) + (1 - {alpha}) / n.n AS rank
  FROM v CROSS JOIN n
  CROSS JOIN (SELECT coalesce(sum(rank), 0) AS lost FROM r{i - 1} WHERE id NOT IN (SELECT id FROM deg)) l
  LEFT JOIN (
    SELECT e.dst AS id, sum(r.rank * e.times / d.degree) AS s
    FROM e JOIN r{i - 1} r ON r.id = e.src JOIN deg d ON d.id = e.src GROUP BY 1
  ) g ON g.id = v.id
)"""
        )
    return f"{edges},\n" + ",\n".join(steps)


def hits_sql(edges: str, rounds: int) -> str:
    """HITS with one table expression per round, over table e."""
    steps = [
        "v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)",
        "h0 AS (SELECT id, 1.0::DOUBLE AS hub, 1.0::DOUBLE AS authority FROM v)",
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""h{i} AS MATERIALIZED (
  SELECT v.id, coalesce(o.s, 0) AS hub, coalesce(a.s, 0) AS authority FROM v
  LEFT JOIN (SELECT e.src AS id, sum(e.times * h.authority) AS s FROM e JOIN h{i - 1} h ON h.id = e.dst GROUP BY 1) o
    ON o.id = v.id
  LEFT JOIN (SELECT e.dst AS id, sum(e.times * h.hub) AS s FROM e JOIN h{i - 1} h ON h.id = e.src GROUP BY 1) a
    ON a.id = v.id
)"""
        )
    return f"{edges},\n" + ",\n".join(steps)


@check(f"WITH {pagerank_sql(TRADE_SQL)} SELECT id, round(rank * 1e6, 6) AS rank FROM r{ROUNDS}")
def pagerank(spark: SparkSession, d: str) -> DataFrame:
    """Ranks in millionths."""
    ranks = graph.pagerank(trade_edges(spark, d), iterations=ROUNDS)
    return ranks.select("id", r6(F.col("rank") * 1e6).alias("rank"))


def page_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.edges(graph.link_graph(pages(spark, d)))


@check(f"WITH {pagerank_sql(PAGE_EDGES_SQL)} SELECT id AS url, round(rank * 1e6, 6) AS rank FROM r{ROUNDS}")
def pagerank_pages(spark: SparkSession, d: str) -> DataFrame:
    """Most vertices here are only linked to, so most of the rank has to be handed round."""
    ranks = graph.pagerank(page_edges(spark, d), iterations=ROUNDS)
    return ranks.select(F.col("id").alias("url"), r6(F.col("rank") * 1e6).alias("rank"))


@check(f"WITH {pagerank_sql(TRADE_SQL)} SELECT count(*) AS vertices, round(sum(rank), 6) AS total FROM r{ROUNDS}")
def pagerank_dangling(spark: SparkSession, d: str) -> DataFrame:
    """Ranks add up to 1 although customers link nowhere."""
    ranks = graph.pagerank(trade_edges(spark, d), iterations=ROUNDS)
    return ranks.agg(F.count(F.lit(1)).alias("vertices"), r6(F.sum("rank")).alias("total"))


def named_edges(spark: SparkSession, d: str) -> DataFrame:
    """Customers and the parts they ordered, with the type in the name, as an edge list."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    pair = F.concat(
        F.lit("  <person/"), F.col("o_custkey").cast("string"), F.lit(">\t <series/"),
        F.col("l_partkey").cast("string"), F.lit("> "),
    )
    return GS.parse_edges(lines.join(orders, "l_orderkey").select(pair.alias("value")))


NAMED_SQL = """
e AS (
  SELECT '<person/' || o_custkey || '>' AS src, '<series/' || l_partkey || '>' AS dst, count(*) AS times
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2
)"""


@check(f"WITH {NAMED_SQL} SELECT src, count(*) AS targets, CAST(sum(times) AS BIGINT) AS edges FROM e GROUP BY 1")
def edge_list(spark: SparkSession, d: str) -> DataFrame:
    merged = named_edges(spark, d).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("times"))
    return merged.groupBy("src").agg(
        F.count(F.lit(1)).alias("targets"), F.sum("times").alias("edges")
    )


@check(f"WITH {hits_sql(TRADE_SQL, HITS_ROUNDS)} SELECT id, round(log10(1 + hub), 6) AS hub, round(log10(1 + authority), 6) AS authority FROM h{HITS_ROUNDS}")
def hits(spark: SparkSession, d: str) -> DataFrame:
    """Scores grow without bound, so their logarithms are compared."""
    scores = graph.hits(trade_edges(spark, d), iterations=HITS_ROUNDS)
    return scores.select(
        "id",
        r6(F.log10(1 + F.col("hub"))).alias("hub"),
        r6(F.log10(1 + F.col("authority"))).alias("authority"),
    )


@check(f"""
WITH {hits_sql(PAGE_EDGES_SQL, HITS_ROUNDS)},
l AS (SELECT sqrt(sum(hub * hub)) AS h, sqrt(sum(authority * authority)) AS a FROM h{HITS_ROUNDS})
SELECT id AS url, round(hub / l.h, 6) AS hub, round(authority / l.a, 6) AS authority FROM h{HITS_ROUNDS}, l
""")
def hits_normalized(spark: SparkSession, d: str) -> DataFrame:
    scores = graph.hits(page_edges(spark, d), iterations=HITS_ROUNDS, normalize=True)
    return scores.select(
        F.col("id").alias("url"), r6("hub").alias("hub"), r6("authority").alias("authority")
    )


@check(f"""
WITH {hits_sql(NAMED_SQL, 5)}
(SELECT 'person' AS kind, id, hub AS score FROM h5 WHERE substr(id, 2, 6) = 'person' ORDER BY hub DESC, id LIMIT 5)
UNION ALL
(SELECT 'series', id, authority FROM h5 WHERE substr(id, 2, 6) = 'series' ORDER BY authority DESC, id LIMIT 5)
""")
def hits_typed(spark: SparkSession, d: str) -> DataFrame:
    """Five best hubs of one type and five best authorities of the other."""
    scores = graph.hits(named_edges(spark, d), iterations=5)
    best = [
        graph.top_vertices(graph.of_type(scores, kind), score).select(
            F.lit(kind).alias("kind"), "id", F.col(score).alias("score")
        )
        for kind, score in (("person", "hub"), ("series", "authority"))
    ]
    return best[0].unionByName(best[1])


def _numbered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    dictionary, merged = graph.number_urls(graph.link_graph(pages(spark, d)))
    edges = merged.filter(F.col("link_id").isNotNull()).select(
        F.col("id").alias("src"), F.col("link_id").alias("dst"), "times"
    )
    return dictionary, edges


NUMBERED_EDGES_SQL = f"""
{NUMBERED_SQL},
e AS (
  SELECT s.id AS src, t.id AS dst, m.times FROM merged m JOIN ids s ON s.url = m.url JOIN ids t ON t.url = m.link
)"""


@check(f"""
WITH {pagerank_sql(NUMBERED_EDGES_SQL)}
SELECT i.url, round(r.rank * 1e6, 6) AS score FROM r{ROUNDS} r JOIN ids i USING (id)
ORDER BY round(r.rank, 15) DESC, r.id LIMIT 20
""")
def top_n_rank(spark: SparkSession, d: str) -> DataFrame:
    """Best pages by rank, with their urls."""
    dictionary, edges = _numbered(spark, d)
    ranks = graph.pagerank(edges, iterations=ROUNDS).withColumn("rank", F.round("rank", 15))
    return graph.top_n(ranks, dictionary, 20).withColumn("score", r6(F.col("score") * 1e6))


@check(f"""
WITH {hits_sql(NUMBERED_EDGES_SQL, HITS_ROUNDS)}
SELECT i.url, h.authority AS score FROM h{HITS_ROUNDS} h JOIN ids i USING (id) ORDER BY h.authority DESC, h.id LIMIT 20
""")
def top_n_authority(spark: SparkSession, d: str) -> DataFrame:
    dictionary, edges = _numbered(spark, d)
    return graph.top_n(graph.hits(edges, iterations=HITS_ROUNDS), dictionary, 20, "authority")
