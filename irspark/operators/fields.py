"""Field texts of parsed pages, stemmed pages and queries, and the corpus sample for fitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.functions.html import TEXT_TAGS
from irspark.functions.text import normalize_text
from irspark.operators.html import meta_content, parse_pages, text_by_tag, title_text
from irspark.plans.ordering import prefix_sum


def join_runs(by_tag: Column, tags: Sequence[str] | None = None) -> Column:
    """Runs of the wanted tags (all when None), one per line, tags in first-seen order."""
    kept = by_tag if tags is None else F.filter(by_tag, lambda t: t["tag"].isin(list(tags)))
    return F.array_join(F.flatten(F.transform(kept, lambda t: t["runs"])), "\n")


def page_fields(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page: text by tag plus title, description and keywords."""
    items = F.col("items")
    return parse_pages(pages.select(key, html), html).select(
        F.col(key).alias("doc_id"),
        text_by_tag(items).alias("by_tag"),
        title_text(items).alias("title"),
        meta_content(items, "description").alias("description"),
        meta_content(items, "keywords").alias("keywords"),
    )


def paragraph_text() -> Column:
    return join_runs(F.col("by_tag"), ["p"])


def all_text() -> Column:
    return join_runs(F.col("by_tag"))


def tagged_text(tags: Sequence[str] = TEXT_TAGS) -> Column:
    return join_runs(F.col("by_tag"), tags)


def training_text(tags: Sequence[str] = TEXT_TAGS) -> Column:
    """Whitelisted runs followed by title, description and keywords, one per line."""
    wanted = F.filter(F.col("by_tag"), lambda t: t["tag"].isin(list(tags)))
    runs = F.flatten(F.transform(wanted, lambda t: t["runs"]))
    return F.array_join(F.concat(runs, F.array("title", "description", "keywords")), "\n")


def field_texts(fields: DataFrame, tags: Sequence[str] = TEXT_TAGS) -> DataFrame:
    """Long form doc_id, field, text of the four scored fields."""
    four = F.array(
        F.struct(F.lit("text").alias("field"), tagged_text(tags).alias("text")),
        *[
            F.struct(F.lit(name).alias("field"), F.col(name).alias("text"))
            for name in ("title", "keywords", "description")
        ],
    )
    return fields.select("doc_id", F.explode(four).alias("f")).select("doc_id", "f.field", "f.text")


def normalize_pages(documents: DataFrame, mode: str = "words") -> DataFrame:
    """Stem title, description, keywords, every run and every attribute value of parsed pages."""

    def stem(text: Column) -> Column:
        return normalize_text(text, mode)

    def stem_all(texts: Column) -> Column:
        return F.transform(texts, stem)

    return documents.select(
        "number",
        "url",
        stem(F.col("title")).alias("title"),
        stem(F.col("description")).alias("description"),
        stem(F.col("keywords")).alias("keywords"),
        F.transform_values("text", lambda _, runs: stem_all(runs)).alias("text"),
        F.transform_values(
            "attr", lambda _, attrs: F.transform_values(attrs, lambda _, v: stem_all(v))
        ).alias("attr"),
    )


def normalize_queries(queries: DataFrame, mode: str = "words") -> DataFrame:
    return queries.withColumn("query", normalize_text(F.col("query"), mode))


def random_order(key: Column, seed: str) -> Column:
    """Sort key of a repeatable random order."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def corpus_sample(
    texts: DataFrame, max_chars: int, order: Sequence[Column], text: str = "text"
) -> DataFrame:
    """Rows in the given ascending order until their characters pass `max_chars`.

    `order` holds plain expressions that name a row. The row that crosses the limit is kept.
    Running sums go over the lengths alone, distributed over ranges of the order; all that comes
    back is the place of the last row kept, so no text moves.
    """
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    lengths = texts.select(place.alias("_place"), F.length(text).cast("bigint").alias("_len"))
    summed = prefix_sum(lengths, [], [F.col("_place")], {"_sum": F.col("_len")})
    # A row without a text adds nothing; the sum before it decides.
    before = F.col("_sum") - F.coalesce(F.col("_len"), F.lit(0))
    last = summed.filter(F.coalesce(before, F.lit(0)) <= max_chars).agg(F.max("_place"))
    return texts.filter(place <= last.scalar())
