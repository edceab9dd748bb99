"""All links between sets that share a bucket, without listing the pairs of a bucket.

First every set is compared with one leader of each of its buckets: the member that shares most
with others. Links to leaders join the bulk of a group. What is left are pairs of one bucket,
neither of them the leader, whose components differ. The caller compares these whole, inside a
task or a join that gives the links alone, so no partner is left out and no pair is listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from irspark.llm.components import components
from irspark.plans.lineage import materialize
from irspark.plans.skew import hot_keys, lookup_join, skew_join

def shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows (key, id) of buckets that hold two different ids, each once, as a written table."""
    marked = buckets.select("key", F.xxhash64("id").alias("h"))
    keys = marked.groupBy("key").agg(F.min("h").alias("l"), F.max("h").alias("m")).filter("l <> m").select("key")
    return materialize(lookup_join(buckets, materialize(keys), ["key"]).select("key", "id").distinct())


def _leaders(live: DataFrame) -> DataFrame:
    """key, leader: the id with the largest sum of bucket sizes, of equals the largest id."""
    counts = materialize(live.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    weights = materialize(lookup_join(live, counts, ["key"]).groupBy("id").agg(F.sum("n").alias("w")))
    best = lookup_join(live, weights, ["id"]).groupBy("key").agg(F.max(F.struct("w", "id")).alias("best"))
    return materialize(best.select("key", F.col("best.id").alias("leader")))


def _open(live: DataFrame, leaders: DataFrame, roots: DataFrame) -> DataFrame:
    """key, id, root of buckets whose members, without the leader, are in several components.

    Of buckets with the same members, one stays.
    """
    return open_members(lookup_join(live, leaders, ["key"]).filter("id <> leader").select("key", "id"), roots)


def open_members(led: DataFrame, roots: DataFrame) -> DataFrame:
    """`_open` from the members (key, id) of buckets, without their leaders."""
    placed = lookup_join(led, roots.select(F.col("node").alias("id"), "root"), ["id"], "left")
    placed = placed.withColumn("root", F.coalesce("root", "id"))
    placed = materialize(placed.withColumns({"h": F.xxhash64("root"), "i": F.xxhash64("id").cast("decimal(20,0)")}))
    buckets = placed.groupBy("key").agg(F.min("h").alias("l"), F.max("h").alias("m"), F.sum("i").alias("members"),
                                        F.count(F.lit(1)).alias("n"))
    kept = buckets.filter("l <> m").groupBy("members", "n").agg(F.min("key").alias("key"))
    return materialize(lookup_join(placed, materialize(kept.select("key", "n")), ["key"]).select("key", "n", "id", "root"))


def link(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
         rest: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components (node, root) of the ids of `buckets` (key, id).

    `verify` gets candidate pairs (a, b) and returns those that are similar. `rest` gets buckets
    (key, n members, id, root) and returns the similar pairs (a, b) of one bucket with different
    roots. Ids without a link are not listed.
    """
    live = shared_buckets(buckets)
    leaders = _leaders(live)
    pairs = lookup_join(live, leaders, ["key"]).filter("id <> leader").select(
        F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    links = materialize(verify(materialize(pairs)).select("a", "b"))
    roots = materialize(components(links))
    more = materialize(rest(_open(live, leaders, roots)).select("a", "b").distinct())
    if more.isEmpty():
        return roots
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return materialize(components(stars.unionByName(more)))


def with_values(pairs: DataFrame, values: DataFrame, value: str, rows: int) -> DataFrame:
    """Pairs (a, b) with the value of both ids as `left` and `right`; frequent ids are split."""
    given = values.select(F.col("id").alias("a"), F.col(value).alias("left"))
    half = skew_join(pairs, given, ["a"], rows=rows, salt_on=["b"], heavy=hot_keys(pairs, ["a"], rows))
    given = values.select(F.col("id").alias("b"), F.col(value).alias("right"))
    return skew_join(half, given, ["b"], rows=rows, salt_on=["a"], heavy=hot_keys(pairs, ["b"], rows))
