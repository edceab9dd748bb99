"""Mixing sources to target weights: random order, prefix sums of sizes, exact cuts.

Every row has a random key from a hash of its id, the same in each run. The rows of a source in
the order of their keys are its random permutation. Sizes are added up along that order in two
levels: over equal ranges of the key, and over the rows of the one range in which the source's
budget ends. A row before the cut is taken once more than a row after it; the row at the cut is
taken in part, so that a source gives exactly its budget. What is left of a budget after whole
passes over the source (epochs) is what has to be cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.limits import ROWS_PER_TASK, limit
from irspark.plans.ordering import prefix_sum, row_index
from irspark.plans.skew import lookup_join

# Rows of a source in one range of keys.
_ROWS_PER_RANGE = 1_000
# The key has 60 bits; its upper 30 choose the range.
_KEY_DIGITS, _RANGE_BITS = 15, 30
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words; 0 without a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(seed: int, *ids: Column) -> Column:
    """60 random bits from the md5 of a seed and the row's id."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in ids]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, _KEY_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target of each source: source, rows, source_size -> and target.

    Sources in ascending order, null last, have the weights in turn. They share `share` times the
    total size by weight; none gets more than `most` times its own size, and what it can't take
    is shared among the others by weight, until nobody is above. That is a water level: sources
    in the order of limit / weight are full as long as the level, (budget - limits of the full) /
    weights of the others, is at their ratio or above.
    """
    n = sizes.count()
    spark = sizes.sparkSession
    in_one_task = n <= limit(spark, ROWS_PER_TASK)
    ascending = [F.col("source").asc_nulls_last()]
    if in_one_task:
        ranked = sizes.withColumn("_i", F.row_number().over(Window.orderBy(*ascending)) - 1)
    else:
        ranked = row_index(sizes, ascending, "_i")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumn("_w", F.get(turn, F.pmod(F.col("_i"), F.lit(len(weights))).cast("int")))
    full = F.lit(float(most)) * F.col("source_size")
    weighed = materialize(weighed.withColumn("_limit", full).withColumn("_ratio", full / F.col("_w")))
    total = weighed.agg(F.sum("source_size"), F.sum("_w")).first()
    budget, weight = share * (total[0] or 0), total[1] or 0.0
    by_ratio = [F.col("_ratio"), F.col("_i")]
    if in_one_task:
        w = Window.orderBy(*by_ratio).rowsBetween(Window.unboundedPreceding, 0)
        summed = weighed.withColumns({"_limits": F.sum("_limit").over(w), "_weights": F.sum("_w").over(w)})
    else:
        summed = prefix_sum(weighed, [], by_ratio, {"_limits": F.col("_limit"), "_weights": F.col("_w")})
    # Level if exactly the sources before this one are full; this one is not if its ratio is above.
    before_limits, before_weights = F.col("_limits") - F.col("_limit"), F.col("_weights") - F.col("_w")
    level = F.try_divide(F.lit(budget) - before_limits, F.lit(weight) - before_weights)
    levels = materialize(summed.withColumn("_level", level))
    first = levels.filter("_level < _ratio").agg(F.min_by("_level", F.struct("_ratio", "_i"))).first()[0]
    target = F.col("_limit") if first is None else F.least(F.col("_limit"), F.lit(first) * F.col("_w"))
    return levels.select("source", "rows", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float], share: float, most: float, size: Column | None = None,
        source: str = "source", ids: Sequence[str] = ("doc_id",), seed: int = 0) -> DataFrame:
    """Add size, source_size, target and taken to every row.

    `size` defaults to the number of words of `text`. taken: how much of the row the mix takes,
    counting repeats: whole epochs times its size, and once more before the cut. Rows with equal
    keys (repeated ids, or none) at the cut share what is left by size, rounded down. Null is a
    source of its own; a source of size 0 has target 0. Columns with the added names are
    replaced; an empty table stays empty. The texts are never shuffled: all sums run over narrow
    rows, and each source's cut, one row per source, is joined to the documents.
    """
    size = words(docs["text"]) if size is None else size
    added = ("size", "source_size", "target", "taken", "_source", "_key")
    keep = [docs[c] for c in docs.columns if c not in added]
    # A null source needs a name to be joined by.
    named = F.coalesce(F.concat(F.lit("="), docs[source].cast("string")), F.lit("null"))
    rows = docs.select(*keep, size.cast("bigint").alias("size"), named.alias("_source"),
                       random_key(seed, *[docs[c] for c in ids]).alias("_key"))
    narrow = materialize(rows.select("_source", "_key", "size"))
    cuts = _cuts(narrow, weights, share, most)
    again = F.when(F.col("_key") < F.col("_cut"), F.col("size")).when(
        F.col("_key") == F.col("_cut"), F.expr("size * _left div _of")
    ).otherwise(F.lit(0))
    taken = (F.col("_epochs") * F.col("size") + again).cast("bigint")
    return lookup_join(rows, cuts, ["_source"]).withColumn("taken", taken).drop(
        "_source", "_key", "_cut", "_left", "_of", "_epochs")


def _cuts(narrow: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """_source, source_size, target, _epochs, and where the next pass ends: _cut, _left, _of."""
    sizes = narrow.groupBy("_source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    plain = F.when(F.col("_source") != "null", F.expr("substr(_source, 2)"))
    wanted = targets(materialize(sizes.select(plain.alias("source"), "rows", "source_size")), weights, share, most)
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    sources = materialize(wanted.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("_source"),
        "source_size", "target", epochs.cast("bigint").alias("_epochs"),
        (budget - epochs * F.col("source_size")).cast("bigint").alias("_rest"),
        F.greatest(F.lit(1), F.floor(F.col("rows") / _ROWS_PER_RANGE)).cast("bigint").alias("_ranges"),
    ))
    of_key = F.shiftright(F.shiftright("_key", 60 - _RANGE_BITS) * F.col("_ranges"), _RANGE_BITS)
    placed = lookup_join(narrow, sources.select("_source", "_ranges", "_rest"), ["_source"]).withColumn("_range", of_key)
    sums = materialize(placed.groupBy("_source", "_rest", "_range").agg(F.sum("size").alias("_sum")))
    upto = prefix_sum(sums, ["_source"], [F.col("_range")], {"_upto": F.col("_sum")})
    before = F.col("_upto") - F.col("_sum")
    # The range in which the budget ends: at most one per source.
    last = materialize(upto.filter((before <= F.col("_rest")) & (F.col("_rest") < F.col("_upto")))
                       .select("_source", "_range", (F.col("_rest") - before).alias("_left")))
    at_cut = lookup_join(placed.select("_source", "_range", "_key", "size"), last, ["_source", "_range"])
    # Rows with equal keys count as one, so a group holds the keys of one range.
    keys = at_cut.groupBy("_source", "_left", "_key").agg(F.sum("size").alias("size"))
    w = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    upto_key = keys.withColumn("_to", F.sum("size").over(w))
    start = F.col("_to") - F.col("size")
    cut = upto_key.filter((start <= F.col("_left")) & (F.col("_left") < F.col("_to"))).select(
        "_source", F.col("_key").alias("_cut"), (F.col("_left") - start).alias("_left"), F.col("size").alias("_of"))
    return materialize(sources.drop("_ranges", "_rest").join(cut, "_source", "left"))
