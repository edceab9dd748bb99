"""Queries on urls and licences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm import hostrank, licenses
from irspark.llm.registry import query, table

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


@query()
def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; tests compare with plain Python."""
    return hostrank.judge(table(spark, sf_dir, "pages"), RULES)


@query()
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document.

    The tables hold no file names, so a document is the file source/lang/hundred/id, where
    hundred is doc_id / 100, and every twentieth document plays a LICENSE file of its folder. Rows
    without an id are files named `none`; those of one folder share what any of them states.
    """
    docs = table(spark, sf_dir, "documents")
    hundred = F.floor(F.col("doc_id") / 100)
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    name = F.when(F.col("doc_id") % 20 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(number)
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), hundred)
    files = docs.select(F.concat_ws("/", folder, name).alias("path"), "text")
    found = licenses.scan(files)
    # The last part of a path is the id with its sign, or `none`, which is no number.
    doc_id = F.regexp_extract("path", r"/(?:LICENSE-)?(-?[0-9]+|none)$", 1).try_cast("bigint")
    return found.select(doc_id.alias("doc_id"), "path", "license", "score", "origin")
