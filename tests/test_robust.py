"""Inputs that used to give wrong or missing results."""

import html

import pytest
from pyspark.sql import functions as F

from irspark.functions.html import tag_items, unescape
from irspark.operators import abtest, graph, vectors


def test_numeric_references_as_the_standard_decoder(spark):
    refs = [f"a&#{n};b" for n in [*range(0, 400), 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFF, 0x10FFFF, 0x110000, 10**30]]
    refs += [f"&#x{n:x};" for n in range(300)] + ["&#000000000000065;", "&#x0000000000041;", "&#X41", "&#65x", "&#0;", "&#00", "&#x;", "&#;"]
    out = spark.createDataFrame([(r,) for r in refs], "t string").select("t", unescape(F.col("t")).alias("u")).collect()
    assert {r.t: r.u for r in out} == {r: html.unescape(r) for r in refs}


@pytest.mark.parametrize("tag", ["script", "style"])
def test_unclosed_body_runs_to_the_end(spark, tag):
    page = f'<p>before</p><{tag}>var a="<p>k";<a href="/x">'
    df = spark.createDataFrame([(page,)], "h string")
    items = df.select(tag_items(F.col("h")).alias("i")).first().i
    assert [(i.tag, i.runs) for i in items if i.tag == "p"] == [("p", ["before"])]


def test_t_test_without_variance(spark):
    def series(x, y):
        rows = [("a", float(v)) for v in x] + [("b", float(v)) for v in y]
        return spark.createDataFrame(rows, "split string, value double")

    for x, y, rejected in (([1, 1], [1, 1], 0), ([1, 1], [2, 2], 1), ([1], [1], 0), ([1], [2], 1), ([1, 2, 3], [1, 2, 3], 0)):
        row = abtest.t_test(series(x, y), "a", "b").first()
        assert row.rejected == rejected


def test_pages_without_html_have_no_links(spark):
    pages = spark.createDataFrame([("http://a.com/1", None), ("http://a.com/2", "")], "url string, html string")
    links = graph.link_graph(pages)
    assert [r.links for r in links.collect()] == [[], []]
    stats = graph.graph_stats(links).first()
    assert (stats.pages, stats.without_links) == (2, 2)


@pytest.mark.parametrize("n", [3, 5, 8, 40])
def test_similar_with_zero_null_and_few_vectors(spark, n):
    rows = [(i, [1.0, i + 1.0] if i < 5 else [0.0, 0.0]) for i in range(n)] + [(100, None), (101, [1.0]), (102, [1.0, None])]
    base = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "query_id bigint, embedding array<double>")
    out = vectors.similar(base, queries, top=8).orderBy("rank").collect()
    assert len(out) == min(n, 8)
    assert out[0].vec_id == 1
    assert [r.vec_id for r in out[5:]] == list(range(5, min(n, 8)))
