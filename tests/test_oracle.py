"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.registry import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


# Work that no built-in function can do: inflating, resizing, models, matrix products, draws from packed arrays.
PYTHON = {"bootstrap", "bootstrap_first", "decode_pages", "packed_pages", "image_features", "similar_vectors", "similar_by_layer"}
PYTHON_NODE = re.compile("EvalPython|InPandas|InArrow|FlatMapGroups")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert bool(PYTHON_NODE.search(plan)) == (name in PYTHON)
    assert compare(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", ["tfidf_rank", "rank_weighted", "number_urls", "pagerank_pages",
                                  "hits", "pair_errors", "lambda_gradient", "delta_ndcg", "have_clicks",
                                  "similar_vectors", "tfidf_lookup", "rank_random_missing"])
def test_matches_sql_when_every_key_is_hot(spark, con, tiny_limits, name):
    assert compare(QUERIES[name](spark, DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "doc_id", "score", "rank"]
