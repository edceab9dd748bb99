import math

import pytest
from pyspark.sql import functions as F

from irspark.operators import fields, ranking, tfidf


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "")], "doc_id long, text string")


def test_idf_and_unit_length(spark, docs):
    idf = {r.term: r for r in tfidf.fit_idf(docs).collect()}
    assert (idf["a"].tf, idf["a"].df) == (2, 1)
    assert idf["b"].idf == pytest.approx(math.log(4 / 3) + 1)
    weights = tfidf.transform(docs, tfidf.fit_idf(docs))
    for r in weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_vocabulary_cap(docs):
    assert [r.term for r in tfidf.fit_vocabulary(docs, 2).orderBy("term").collect()] == ["a", "b"]


def test_unknown_terms_are_left_out(docs):
    idf = tfidf.fit_idf(docs).filter("term <> 'a'")
    got = tfidf.transform(docs, idf).filter("doc_id = 1").collect()
    assert [(r.term, r.weight) for r in got] == [("b", pytest.approx(1.0))]


def test_score_repeats_and_missing(spark, docs):
    queries = spark.createDataFrame([("1", " A a zzz ")], "query_id string, query string")
    cand = spark.createDataFrame([("1", i) for i in (1, 2, 3, 99)], "query_id string, doc_id long")
    weights = tfidf.transform(docs, tfidf.fit_idf(docs))
    w = weights.filter("doc_id = 1 and term = 'a'").first().weight
    got = {r.doc_id: r.score for r in tfidf.score(queries, cand, weights, docs).collect()}
    assert got == {1: pytest.approx(2 * w), 2: 0.0, 3: 0.0, 99: None}


def test_lookup(spark, docs):
    asked = spark.createDataFrame([(1, " A "), (1, "q"), (99, "a")], "doc_id long, term string")
    weights = tfidf.transform(docs, tfidf.fit_idf(docs))
    got = {(r.doc_id, r.term): r.weight for r in tfidf.lookup(asked, weights, docs).collect()}
    assert got[(1, "q")] == 0.0 and got[(99, "a")] is None and got[(1, " A ")] > 0


@pytest.fixture
def scores(spark):
    rows = [("1", 1, "text", 0.5), ("1", 1, "title", 0.1), ("1", 2, "text", 0.2), ("1", 2, "title", 0.9),
            ("1", 9, "text", None), ("1", 9, "title", None)]
    return spark.createDataFrame(rows, "query_id string, doc_id long, field string, score double")


def order(df):
    return [r.doc_id for r in df.orderBy("rank").collect()]


def test_rankings(scores):
    assert order(ranking.rank_by_sum(scores)) == [2, 1, 9]
    assert order(ranking.rank_weighted(scores, {"text": 10.0, "title": 0.1})) == [1, 2, 9]


def test_unlisted_field_is_an_error(scores):
    with pytest.raises(Exception, match="no weight"):
        ranking.rank_weighted(scores, {"text": 1.0}).collect()


def test_merge_only_for_present_pages(scores):
    merged = ranking.merge_families(scores, scores.withColumn("score", F.lit(1.0)))
    got = {(r.doc_id, r.field) for r in merged.collect()}
    assert (1, "xtext") in got and (9, "xtext") not in got and (9, "text") in got


def test_random_places_are_repeatable_and_spread(spark):
    rows = [("1", i, "text", float(i)) for i in range(20)] + [("1", 100 + i, "text", None) for i in range(20)]
    df = spark.createDataFrame(rows, "query_id string, doc_id long, field string, score double")
    first = order(ranking.rank_random_missing(df, "a"))
    assert first == order(ranking.rank_random_missing(df, "a"))
    assert [d for d in first if d < 100] == list(range(19, -1, -1))
    places = [i for i, d in enumerate(first) if d >= 100]
    assert min(places) < 10 and max(places) > 25


def test_corpus_keeps_the_crossing_row(spark):
    df = spark.createDataFrame([(i, "x" * 10) for i in range(10)], "doc_id long, text string")
    kept = fields.corpus_sample(df, 25, [F.col("doc_id")])
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]


def test_texts_never_move(spark, tmp_path):
    rows = [(i, f"w{i % 7} common {'x' * i} word{i}") for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    idf = tfidf.fit_idf(docs)
    for df in (tfidf.fit_vocabulary(docs), tfidf.transform(docs, idf)):
        plan = df._jdf.queryExecution().optimizedPlan()
        nodes, below = [plan], []
        while nodes:
            node = nodes.pop()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
            if node.nodeName() in ("Aggregate", "Window", "RepartitionByExpression", "Join"):
                below += [children.apply(i).output().mkString(",") for i in range(children.size())]
        assert below and not any("text#" in b for b in below)
    kept = fields.corpus_sample(docs, 300, [F.col("doc_id")])
    assert "Exchange" not in kept._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]


def test_sparse_rows(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, None), (3, ""), (4, "x " * 5000 + "é É"), (1, "a")], "doc_id long, text string")
    got = [(r.doc_id, [tuple(c) for c in r.cells or []]) for r in tfidf.sparse_rows(df).collect()]
    assert sorted(got) == [(1, [("a", 1)]), (1, [("a", 1), ("b", 2)]), (2, []), (3, []), (4, [("x", 5000), ("é", 2)])]
    rows = tfidf.sparse_rows(df.filter("doc_id > 1"))
    assert sorted(tfidf.transform(rows, tfidf.fit_idf(rows)).collect()) == sorted(
        tfidf.transform(df.filter("doc_id > 1"), tfidf.fit_idf(df.filter("doc_id > 1"))).collect())


def test_split_terms_give_the_same_weights(spark, tiny_limits):
    rows = [(i, f"common w{i % 3} word{i}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights = tfidf.transform(df, tfidf.fit_idf(df))
    assert weights.count() == 270
    norms = weights.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)


def test_corpus_in_another_order(spark):
    df = spark.createDataFrame([(i, None if i == 3 else "x" * (i + 1)) for i in range(30)], "doc_id long, text string")
    order = [fields.random_order(F.col("doc_id"), "5"), F.col("doc_id")]
    kept = {r.doc_id for r in fields.corpus_sample(df, 100, order).collect()}
    want, total = set(), 0
    for r in df.orderBy(*order).collect():
        if total <= 100:
            want.add(r.doc_id)
        total += len(r.text or "")
    assert kept == want and fields.corpus_sample(df.limit(0), 10, order).count() == 0


def test_lookup_moves_weights_of_asked_terms_only(spark, monkeypatch):
    weights = spark.createDataFrame([(d, f"t{t}", d + t / 10) for d in range(20) for t in range(9)], "doc_id long, term string, weight double")
    asked = spark.createDataFrame([(1, " T2"), (1, "no"), (99, "t2"), (2, None)], "doc_id long, term string")
    moved, join = [], tfidf.skew_join
    monkeypatch.setattr(tfidf, "skew_join", lambda left, right, *a, **k: (moved.append(right.count()), join(left, right, *a, **k))[1])
    got = {(r.doc_id, r.term): r.weight for r in tfidf.lookup(asked, weights, spark.range(20).withColumnRenamed("id", "doc_id")).collect()}
    assert got == {(1, " T2"): 1.2, (1, "no"): 0.0, (99, "t2"): None, (2, None): 0.0}
    assert moved == [20, 20]


def test_families_share_one_scoring(spark, monkeypatch):
    from checks import pages

    calls, score = [], tfidf.score
    monkeypatch.setattr(tfidf, "score", lambda *a, **k: (calls.append(1), score(*a, **k))[1])
    assert {r.field for r in pages.two_families(spark, "/root/testdata/sf0.001").select("field").distinct().collect()} == set(pages.WEIGHTS)
    assert len(calls) == 1
