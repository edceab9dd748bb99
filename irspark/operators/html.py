"""Text, title, metadata, attributes and links of raw pages. Every operator is narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.functions import html as H
from irspark.functions.binding import let
from irspark.functions.urls import normalize_url, resolve_url, same_host


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the html column by `items`, the start tags with attributes and runs."""
    return pages.withColumn("items", H.tag_items(F.col(html))).drop(html)


def _runs_of(items: Column, keep) -> Column:
    return F.flatten(F.transform(F.filter(items, keep), lambda i: i["runs"]))


def title_text(items: Column) -> Column:
    return F.array_join(_runs_of(items, lambda i: i["tag"] == "title"), "")


def meta_content(items: Column, name: str) -> Column:
    """Content of the last `meta` element of that name, '' when there is none."""
    metas = F.transform(
        F.filter(items, lambda i: i["tag"] == "meta"), lambda i: H.attributes(i["attrs"])
    )
    # Names are compared as written, without stripping.
    named = F.filter(
        metas,
        lambda m: F.coalesce(
            F.try_element_at(F.filter(m, lambda p: p["name"] == "name"), F.lit(-1))["value"]
            == name,
            F.lit(False),
        ),
    )
    content = F.transform(named, lambda m: H.attribute(m, "content"))
    return F.coalesce(F.try_element_at(content, F.lit(-1)), F.lit(""))


def text_by_tag(items: Column) -> Column:
    """array<struct<tag, runs>>: runs gathered per tag, tags in first-seen order.

    Title and script are kept out; style counts as text.
    """
    texts = F.filter(
        items, lambda i: ~i["tag"].isin("title", "script") & (F.size(i["runs"]) > 0)
    )

    def grouped(found: Column) -> Column:
        tags = F.array_distinct(F.transform(found, lambda i: i["tag"]))
        return F.transform(
            tags,
            lambda t: F.struct(
                t.alias("tag"), _runs_of(found, lambda i: i["tag"] == t).alias("runs")
            ),
        )

    return let(texts, grouped)


def page_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Text runs in page order: key, pos, tag, text."""
    items = parse_pages(pages.select(key, html), html)
    wanted = F.filter(F.col("items"), lambda i: ~i["tag"].isin("title", "script"))
    runs = F.flatten(
        F.transform(
            wanted,
            lambda i: F.transform(i["runs"], lambda r: F.struct(i["tag"].alias("tag"), r.alias("text"))),
        )
    )
    return items.select(key, F.posexplode(runs).alias("pos", "run")).select(
        key, "pos", "run.tag", "run.text"
    )


def page_title(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return parse_pages(pages.select(key, html), html).select(
        key, title_text(F.col("items")).alias("title")
    )


def page_meta(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    items = F.col("items")
    return parse_pages(pages.select(key, html), html).select(
        key,
        meta_content(items, "description").alias("description"),
        meta_content(items, "keywords").alias("keywords"),
    )


def attr_values(items: Column) -> Column:
    """array<struct<tag, attr, value>> of the non-blank title and alt values, in page order."""

    def of_pairs(tag: Column, pairs: Column) -> Column:
        both = F.array(
            *[
                F.struct(tag.alias("tag"), F.lit(a).alias("attr"), H.attribute(pairs, a).alias("value"))
                for a in ("title", "alt")
            ]
        )
        return F.filter(both, lambda v: v["value"] != "")

    def of_item(i: Column) -> Column:
        return let(H.attributes(i["attrs"]), lambda pairs: of_pairs(i["tag"], pairs))

    return F.flatten(F.transform(items, of_item))


def page_attrs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Values of the title and alt attributes: key, pos, tag, attr, value."""
    items = parse_pages(pages.select(key, html), html)
    return items.select(key, F.posexplode(attr_values(F.col("items"))).alias("pos", "v")).select(
        key, "pos", "v.tag", "v.attr", "v.value"
    )


def page_document(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Whole parsed page as one record: number, url, title, description, keywords, text, attr."""
    items = F.col("items")

    def by_tag(values: Column) -> Column:
        def of_attr(tag: Column, attr: str) -> Column:
            hits = F.filter(values, lambda v: (v["tag"] == tag) & (v["attr"] == attr))
            return F.transform(hits, lambda v: v["value"])

        tags = F.array_distinct(F.transform(values, lambda v: v["tag"]))
        return F.transform(
            tags,
            lambda t: F.struct(
                t,
                F.create_map(F.lit("title"), of_attr(t, "title"), F.lit("alt"), of_attr(t, "alt")),
            ),
        )

    attr = F.map_from_entries(let(attr_values(items), by_tag))
    return parse_pages(pages.select(key, url, html), html).select(
        F.col(key).alias("number"),
        F.col(url).alias("url"),
        title_text(items).alias("title"),
        meta_content(items, "description").alias("description"),
        meta_content(items, "keywords").alias("keywords"),
        F.map_from_entries(text_by_tag(items)).alias("text"),
        attr.alias("attr"),
    )


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """href values in page order: key, pos, href."""
    return pages.select(key, F.posexplode(H.links(F.col(html))).alias("pos", "href"))


def page_links(html: Column, page_url: Column, wanted_host: Column | str) -> Column:
    """Normalised links of a page that stay on the wanted host.

    A link already on the host is taken as written, another is resolved against the page first.
    """
    hrefs = H.links(html)
    chosen = F.transform(
        hrefs,
        lambda h: F.when(same_host(h, wanted_host), h).otherwise(resolve_url(page_url, h)),
    )
    on_host = F.filter(chosen, lambda u: same_host(u, wanted_host))
    return F.transform(on_host, normalize_url)
