"""Rankings from field scores (query_id, doc_id, field, score; null = page not available)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.ordering import rank_within
from irspark.plans.skew import lookup_join

# Scores are compared at this many digits, so that summation order cannot change a rank.
DIGITS = 9
MISSING = -1.0


def _order(score: Column) -> list[Column]:
    return [F.round(score, DIGITS).desc_nulls_last(), F.col("doc_id").asc()]


def total_score(scores: DataFrame) -> DataFrame:
    """Sum of the field scores, -1 for a missing page."""
    return scores.groupBy("query_id", "doc_id").agg(
        F.coalesce(F.sum("score"), F.lit(MISSING)).alias("score")
    )


def rank_by_sum(scores: DataFrame) -> DataFrame:
    """Documents by total score; missing pages count as -1."""
    return rank_missing_last(total_score(scores))


def weighted_score(scores: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted sum over fields, null for a missing page; an unlisted field is an error."""
    weight = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    known = F.when(F.col("field").isin(list(weights)), F.element_at(weight, F.col("field")))
    checked = F.coalesce(known, F.raise_error(F.concat(F.lit("no weight for field "), "field")).cast("double"))
    return scores.groupBy("query_id", "doc_id").agg(F.sum(F.col("score") * checked).alias("score"))


def rank_weighted(scores: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Documents by weighted score, missing pages last."""
    return rank_missing_last(weighted_score(scores, weights))


def rank_missing_last(totals: DataFrame) -> DataFrame:
    """Documents by score, null last. Totals are written once, as ranking reads them twice."""
    return rank_within(materialize(totals), ["query_id"], _order(F.col("score")))


def merge_families(scores: DataFrame, others: DataFrame, prefix: str = "x") -> DataFrame:
    """Add a second family of field scores under prefixed names, for pages the first one has."""
    have = (
        scores.filter(F.col("score").isNotNull()).select("query_id", "doc_id").distinct()
    )
    renamed = others.withColumn("field", F.concat(F.lit(prefix), "field"))
    return scores.unionByName(renamed.join(have, ["query_id", "doc_id"], "left_semi"))


def uniform(seed: str, *keys: str) -> Column:
    """Repeatable number in [0, 1) from the key columns."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)


def rank_random_missing(scores: DataFrame, seed: str = "0") -> DataFrame:
    """Rank by total score, missing pages put at random places between the others."""
    totals = materialize(total_score(scores))
    good = rank_within(
        totals.filter(F.col("score") != MISSING), ["query_id"], _order(F.col("score")), "place"
    ).withColumn("place", F.col("place").cast("double"))
    sizes = totals.groupBy("query_id").agg(
        F.count(F.when(F.col("score") != MISSING, 1)).alias("n_good")
    )
    bad = lookup_join(totals.filter(F.col("score") == MISSING), sizes, ["query_id"])
    slot = F.floor(uniform(seed, "query_id", "doc_id") * (F.col("n_good") + 1))
    bad = bad.select("query_id", "doc_id", "score", (slot + 0.5).alias("place"))
    mixed = good.select("query_id", "doc_id", "score", "place").unionByName(bad)
    return rank_within(mixed, ["query_id"], [F.col("place").asc(), F.col("doc_id").asc()]).drop(
        "place"
    )
