import pytest
from pyspark.sql import functions as F

from irspark.plans.limits import BROADCAST_BYTES, ROWS_PER_TASK
from irspark.plans.lineage import checkpoint_dir, materialize
from irspark.plans.ordering import prefix_sum, rank_within, row_index, top_rows, top_within
from irspark.plans.skew import hot_keys, lookup_join, skew_join


@pytest.fixture
def skewed(spark):
    """One key holds two thirds of the rows."""
    return spark.range(300).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v")
    )


@pytest.fixture(params=[10, 10_000_000])
def rows_per_task(request, spark):
    spark.conf.set(ROWS_PER_TASK[0], str(request.param))
    yield request.param
    spark.conf.unset(ROWS_PER_TASK[0])


def test_row_index_is_dense_and_ordered(skewed):
    got = row_index(skewed, [F.col("v").desc()]).orderBy("row_idx").collect()
    assert [r.row_idx for r in got] == list(range(300))
    assert [r.v for r in got] == list(range(299, -1, -1))


def test_rank_and_prefix_sum(skewed, rows_per_task):
    pdf = skewed.toPandas().sort_values(["k", "v"])
    pdf["rank"] = pdf.groupby("k").cumcount() + 1
    pdf["s"] = pdf.groupby("k").v.cumsum()
    got = rank_within(skewed, ["k"], [F.col("v").asc()]).toPandas().sort_values(["k", "v"])
    assert got["rank"].tolist() == pdf["rank"].tolist()
    got = prefix_sum(skewed, ["k"], [F.col("v").asc()], {"s": F.col("v")}).toPandas().sort_values(["k", "v"])
    assert got["s"].tolist() == pdf["s"].tolist()


def test_rank_with_null_keys(spark, rows_per_task):
    df = spark.createDataFrame([(None, i) for i in range(40)] + [(1, 5)], "k long, v long")
    got = rank_within(df, ["k"], [F.col("v").asc()]).filter("k is null").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 41))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, skewed, rows_per_task, how):
    right = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (99, "d")], "k long, name string")
    want = skewed.join(right, "k", how).toPandas().sort_values(["v", "name"]).reset_index(drop=True)
    got = skew_join(skewed, right, ["k"], how, rows=rows_per_task).toPandas()
    got = got.sort_values(["v", "name"]).reset_index(drop=True)
    assert got[want.columns].equals(want)


def test_skew_join_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 7)], "k long, v long")
    right = spark.createDataFrame([(1, "a"), (None, "b")], "k long, name string")
    got = skew_join(left, right, ["k"], "left", rows=10)
    assert got.count() == 51 and got.filter("name is not null").count() == 1


def test_hot_keys_parts(skewed):
    assert [(r.k, r._parts) for r in hot_keys(skewed, ["k"], 50).collect()] == [(0, 5)]


def test_top(skewed, rows_per_task):
    assert top_within(skewed, ["k"], [F.col("v").asc()], 2).filter("k = 0").count() == 2
    assert [r.v for r in top_rows(skewed, [F.col("v").desc()], 3).orderBy("v").collect()] == [297, 298, 299]


def test_top_is_cut_before_the_shuffle(skewed):
    plan = top_within(skewed, ["k"], [F.col("v").asc()], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_checkpoint_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert checkpoint_dir(spark) == configured.rstrip("/")
    table = materialize(spark.range(5))
    assert table.count() == 5
    assert all(checkpoint_dir(spark).removeprefix("file:") in f for f in table.inputFiles())


def test_bucketed_rows_stay_where_they_are(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = materialize(spark.range(100).withColumn("w", F.lit(1)), ["id"], 4)
        plan = table.join(spark.range(100), "id")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("wide, sent", [(1, True), (1000, False)])
def test_lookup_join_counts_bytes(spark, wide, sent):
    """Few rows are not sent to all tasks if their strings and arrays are long."""
    value = F.array_repeat(F.col("id"), wide)
    table = spark.range(100).select("id", value.alias("a"), F.struct(value, F.repeat(F.lit("x"), F.lit(wide))).alias("s"),
                                    F.array(F.repeat(F.lit("x"), F.lit(wide))).alias("t"), F.lit(None).cast("string").alias("u"))
    spark.conf.set(BROADCAST_BYTES[0], "100000")
    try:
        joined = lookup_join(spark.range(300), table, ["id"])
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(BROADCAST_BYTES[0])
    assert ("_salt" not in plan) == sent
    assert joined.count() == 100
