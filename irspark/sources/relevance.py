"""Readers and writers of the text-relevance task: queries, candidates, urls, pages, rankings."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from irspark.plans.lineage import materialize
from irspark.plans.ordering import prefix_sum, rank_within

# Workers get the functions of this module with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGE_SCHEMA = (
    "number bigint, url string, title string, description string, keywords string, "
    "text map<string,array<string>>, attr map<string,map<string,array<string>>>"
)


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    # Fields are plain text: no quoting, no escapes.
    return spark.read.csv(path, sep="\t", schema=schema, quote="", escape="", encoding="UTF-8")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """query_id, query."""
    return _tsv(spark, path, "query_id string, query string")


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, url, path of the page file."""
    return _tsv(spark, path, "doc_id bigint, url string, path string")


def file_rows(df_text: DataFrame) -> list[Column]:
    """Order of lines as they stand in the files of a text source."""
    return [F.col("_file"), F.col("_start"), F.col("_mid")]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with the columns that give their order."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """JSON object query -> document ids, as rows query_id, pos, doc_id.

    A file holds one object or several. It is read in pieces that end with a bracket, by as many
    tasks as it has splits, and each piece holds one list with its query. A bracket inside a query
    cuts that query in two; such pieces are those between two with an odd number of quotes, and
    are put together again. A list must fit a row, the object need not. Null lists, and entries
    that are no lists of integers, give no rows; an empty file or object gives none.
    """
    pieces = spark.read.option("lineSep", "]").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    return candidates_from_pieces(materialize(pieces))


def candidates_from_pieces(pieces: DataFrame) -> DataFrame:
    """query_id, pos, doc_id of the pieces (value, _file, _start, _mid) of JSON text cut at each `]`."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    odd = (F.regexp_count(plain, F.lit('"')) % 2).alias("_odd")
    places = pieces.select("_file", "_start", "_mid", odd)
    if places.filter("_odd = 1").isEmpty():
        return _entries(pieces.select("value"))
    # An odd running number of quotes: the piece ends inside a query.
    running = prefix_sum(places, ["_file"], [F.col("_start"), F.col("_mid")], {"_quotes": F.col("_odd")})
    inside = F.col("_quotes") % 2 == 1
    cut = running.filter(inside | (F.col("_odd") == 1)).select(
        "_mid", F.floor((F.col("_quotes") - F.when(inside, 1).otherwise(2)) / 2).alias("_entry")
    )
    placed = pieces.join(cut, "_mid", "left")
    whole = placed.filter("_entry is null").select("value")
    # One group is one query of the object, with its list.
    in_order = F.sort_array(F.collect_list(F.struct("_start", "_mid", "value")))
    joined = (
        placed.filter("_entry is not null")
        .groupBy("_file", "_entry")
        .agg(F.array_join(F.transform(in_order, lambda x: x["value"]), "]").alias("value"))
        .select("value")
    )
    return _entries(whole.unionByName(joined))


def _entries(pieces: DataFrame) -> DataFrame:
    """Rows of pieces `, "query": [1, 2` without their closing bracket."""
    opened = F.regexp_replace("value", r"^[\s{},\uFEFF]+", "")
    return candidates_from_json(
        pieces.select(opened.alias("value"))
        # What follows the last list of an object holds no list.
        .filter((F.col("value") != "") & ~F.col("value").rlike(r"\}\s*$"))
        .select(F.concat(F.lit("{"), "value", F.lit("]}")).alias("value")),
        "value",
    )


def write_candidates(candidates: DataFrame, path: str) -> None:
    """Rows query_id, pos, doc_id as JSON objects of one query and its list each, one a line."""
    docs = F.transform(F.sort_array(F.collect_list(F.struct("pos", "doc_id"))), lambda x: x["doc_id"])
    candidates.groupBy("query_id").agg(docs.alias("docs")).select(
        F.to_json(F.create_map("query_id", "docs")).alias("value")
    ).write.mode("overwrite").text(path)


def candidates_from_json(df: DataFrame, column: str) -> DataFrame:
    lists = df.select(F.explode(F.from_json(column, "map<string,array<bigint>>")).alias("query_id", "docs"))
    return lists.select("query_id", F.posexplode("docs").alias("pos", "doc_id"))


def candidates(sample: DataFrame, order: list[Column]) -> DataFrame:
    """Document ids of every query in sample order: query_id, pos, doc_id."""
    ranked = rank_within(sample, ["query_id"], order, "_rank")
    return ranked.select("query_id", (F.col("_rank") - 1).alias("pos"), "doc_id")


def number_in_name(file_name: Column) -> Column:
    """First number in a file name."""
    return F.regexp_extract(file_name, r"\d+", 0).try_cast("bigint")


def drop_first_line(text: Column) -> Column:
    """Text without its first line."""
    return F.regexp_replace(text, r"\A[^\n]*\n?", "")


def read_without_first_line(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: file name and its text without the first line."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), drop_first_line(F.col("value")).alias("text")
    )


def write_without_first_line(spark: SparkSession, path: str, out: str) -> None:
    """Copy a folder of text files, grouped by sub-folder, each without its first line."""
    whole = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    file = F.col("_metadata.file_path")
    whole.select(
        F.element_at(F.split(file, "/"), -2).alias("folder"),
        F.col("_metadata.file_name").alias("file"),
        drop_first_line(F.col("value")).alias("text"),
    ).write.mode("overwrite").partitionBy("folder").parquet(out)


@F.pandas_udf(T.StringType())
def _decode_cyrillic(content: pd.Series) -> pd.Series:
    def decode(raw):
        if raw is None:
            return None
        try:
            return bytes(raw).decode("cp1251")
        except UnicodeDecodeError:
            return None

    return content.map(decode)


def decode_content(pages: DataFrame, content: str = "content", name: str = "html") -> DataFrame:
    """Text of raw bytes: utf-8 if valid, else windows-1251, else the row is dropped.

    Valid rows are decoded by the JVM; only the others visit a Python worker.
    """
    raw = F.col(content)
    text = raw.cast("string")
    utf8 = pages.filter(F.is_valid_utf8(text)).withColumn(name, text)
    other = (
        pages.filter(~F.is_valid_utf8(text))
        .withColumn(name, _decode_cyrillic(raw))
        .filter(F.col(name).isNotNull())
    )
    return utf8.unionByName(other).drop(content)


def read_raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files as number (from the name) and html."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(number_in_name(F.element_at(F.split("path", "/"), -1)).alias("page_id"), "content")
    )
    return decode_content(files)


def _inflate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        def inflate(raw):
            # A cut stream yields what could be read, a broken one nothing.
            try:
                return zlib.decompressobj().decompress(raw).decode("utf-8", "replace")
            except (zlib.error, TypeError):
                return None

        yield pd.DataFrame({"id": batch["id"], "html": batch["packed"].map(inflate)})


def read_packed_pages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines `id <tab> base64(deflate(html))` as id, html; unreadable pages have a null html."""
    parts = F.split(F.col(column), "\t")
    packed = lines.select(
        F.get(parts, F.lit(0)).try_cast("bigint").alias("id"),
        F.try_to_binary(F.get(parts, F.lit(1)), F.lit("base64")).alias("packed"),
    )
    return packed.mapInPandas(_inflate, "id bigint, html string")


def write_pages(documents: DataFrame, path: str, fmt: str = "json") -> None:
    """Parsed pages, one record per page."""
    documents.write.mode("overwrite").format(fmt).save(path)


def read_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.format(fmt).schema(PAGE_SCHEMA).load(path)


def failed_pages(urls: DataFrame, pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """Catalogue entries without a parsed page."""
    return urls.join(pages.select(key), key, "left_anti")


def ranking_rows(ranking: DataFrame) -> DataFrame:
    """Ranking as submission rows with their place: QueryId, DocumentId, rank."""
    return ranking.select(
        F.col("query_id").cast("bigint").alias("QueryId"),
        F.col("doc_id").alias("DocumentId"),
        "rank",
    )


def write_ranking(ranking: DataFrame, path: str, columns: tuple[str, str] = ("QueryId", "DocumentId")) -> None:
    """CSV in (query as number, rank) order. Part files hold consecutive ranges of that order."""
    ranking_rows(ranking).orderBy("QueryId", "rank").select(*columns).write.mode(
        "overwrite"
    ).csv(path, header=True)
