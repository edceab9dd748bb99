"""Adjacency text, edge lists and url dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.functions.urls import normalize_url
from irspark.plans.limits import ROWS_PER_TASK, limit
from irspark.plans.ordering import prefix_sum

# Links written on one line; a page with more goes on in further lines of the same url.
LINKS_PER_LINE = 100_000


def _fields(line: Column) -> Column:
    return F.split(line, "\t", -1)


def parse_adjacency(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines `url <tab> value <tab> [a, b]`: an empty value or list text is null, [] is empty."""
    parts = _fields(F.col(column))
    value = F.trim(F.get(parts, F.lit(1)))
    listed = F.trim(F.get(parts, F.lit(2)))
    inner = F.expr("substring(_list, 2, length(_list) - 2)")
    links = (
        F.when(F.col("_list") == "", None)
        .when(F.trim(inner) == "", F.array().cast("array<string>"))
        .otherwise(F.split(inner, ", "))
    )
    return (
        lines.filter(F.size(parts) == 3)
        .select(
            F.get(parts, F.lit(0)).alias("url"),
            value.try_cast("double").alias("value"),
            listed.alias("_list"),
        )
        .select("url", "value", links.alias("links"))
    )


def malformed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that do not have three fields."""
    return lines.filter(F.size(_fields(F.col(column))) != 3)


def format_adjacency(graph: DataFrame) -> DataFrame:
    """Inverse of parse_adjacency: one text column `value`."""
    number = F.coalesce(F.col("value").cast("string"), F.lit(""))
    links = F.when(F.col("links").isNull(), "").otherwise(
        F.concat(F.lit("["), F.array_join("links", ", "), F.lit("]"))
    )
    return graph.select(F.concat_ws("\t", "url", number, links).alias("value"))


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return parse_adjacency(spark.read.text(path))


def write_adjacency(graph: DataFrame, path: str) -> None:
    format_adjacency(graph).write.mode("overwrite").text(path)


def edge_rows(edges: DataFrame) -> DataFrame:
    """Equal edges (url, link) as one row with their number: url, link, times.

    A null link (0 times) marks a page without links. This is the form for pages of any size: it
    holds no list.
    """
    return edges.groupBy("url", "link").agg(F.count("link").alias("times"))


def write_edge_rows(rows: DataFrame, path: str) -> None:
    """Lines `url <tab> link <tab> times`; an empty link with 0 times marks a page without links."""
    link = F.coalesce("link", F.lit(""))
    rows.select(F.concat_ws("\t", "url", link, F.col("times").cast("string")).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def read_edge_rows(spark: SparkSession, path: str) -> DataFrame:
    """Inverse of write_edge_rows; lines without three fields or a number are left out."""
    parts = _fields(F.col("value"))
    times = F.get(parts, F.lit(2)).try_cast("bigint")
    return (
        spark.read.text(path)
        .filter((F.size(parts) == 3) & times.isNotNull())
        .select(
            F.get(parts, F.lit(0)).alias("url"),
            F.when(times > 0, F.get(parts, F.lit(1))).alias("link"),
            times.alias("times"),
        )
    )


def adjacency_lists(edges: DataFrame, links_per_line: int = LINKS_PER_LINE) -> DataFrame:
    """Edge rows (url, link) back to lists of bounded length: url, value, links.

    A null link marks a page without links. Running numbers of a page's links, in their order,
    place each in a line; a page with more links than fit goes on in further lines, and so do the
    copies of one link. Equal edges are counted before anything is moved, and the running numbers
    of a large page are made by many tasks.
    """
    size = min(links_per_line, limit(edges.sparkSession, ROWS_PER_TASK))
    placed = prefix_sum(edge_rows(edges), ["url"], [F.col("link").asc_nulls_first()], {"_end": F.col("times")})
    start, end = F.col("_end") - F.col("times"), F.col("_end")
    first, last = F.floor(start / size), F.floor(F.greatest(end - 1, F.lit(0)) / size)
    copies = F.least(end, (F.col("_line") + 1) * size) - F.greatest(start, F.col("_line") * size)
    # A page's mark without links belongs to its first line and adds nothing there.
    lines = placed.select("url", "link", "times", "_end", F.explode(F.sequence(F.least(first, last), last)).alias("_line"))
    listed = F.flatten(F.collect_list(F.array_repeat("link", F.when(F.col("times") > 0, copies).otherwise(0).cast("int"))))
    return (
        lines.groupBy("url", "_line")
        .agg(F.sort_array(listed).alias("links"))
        .select("url", F.lit(None).cast("double").alias("value"), "links")
    )


def parse_edges(lines: DataFrame, column: str = "value") -> DataFrame:
    """White-space separated pairs: src, dst."""
    parts = F.split(F.trim(F.regexp_replace(F.col(column), r"\s+", " ")), " ")
    return lines.select(
        F.get(parts, F.lit(0)).alias("src"), F.get(parts, F.lit(1)).alias("dst")
    ).filter(F.col("dst").isNotNull())


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return parse_edges(spark.read.text(path))


def read_page_urls(spark: SparkSession, path: str) -> DataFrame:
    """`id <tab> url` side table with normalised urls."""
    table = spark.read.csv(path, sep="\t", schema="id bigint, url string", quote="", escape="")
    return table.select("id", normalize_url(F.col("url")).alias("url"))


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """Url dictionary: a first line with the number of urls, then `id <tab> url` by id."""
    count = dictionary.agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit(-1).cast("bigint").alias("id"), "value"
    )
    rows = dictionary.select("id", F.concat_ws("\t", F.col("id").cast("string"), "url").alias("value"))
    count.unionByName(rows).orderBy("id").select("value").write.mode("overwrite").text(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    return (
        spark.read.text(path)
        .filter(F.size(parts) == 2)
        .select(F.get(parts, F.lit(0)).cast("bigint").alias("id"), F.get(parts, F.lit(1)).alias("url"))
    )
