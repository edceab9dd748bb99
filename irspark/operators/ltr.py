"""Learning to rank: DCG family, pair errors, ranking gradient, boosted regression trees.

Rows are query_id, doc_id, label and, where needed, score or features (array<double>). Ties in
score are broken by doc_id.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.limits import PAIR_BLOCK, limit
from irspark.plans.ordering import prefix_sum, rank_within, rows_per_task, top_within
from irspark.plans.pairs import pairwise_sum
from irspark.plans.skew import hot_keys, lookup_join, skew_join

GAINS = ("exponential", "linear")


def gain(label: Column, gains: str = "exponential") -> Column:
    if gains not in GAINS:
        raise ValueError(f"unknown gains {gains!r}, expected one of {GAINS}")
    return F.pow(F.lit(2.0), label) - 1 if gains == "exponential" else label.cast("double")


def discount(rank: Column) -> Column:
    return F.log2(rank + 1)


def _by(column: str) -> list[Column]:
    return [F.col(column).desc(), F.col("doc_id").asc()]


def dcg(
    data: DataFrame, k: int = 10, gains: str = "exponential", score: str = "score"
) -> DataFrame:
    """Discounted gain of the best `k` documents of every query: query_id, dcg."""
    best = top_within(data.select("query_id", "doc_id", "label", score), ["query_id"], _by(score), k)
    return best.groupBy("query_id").agg(
        F.sum(gain(F.col("label"), gains) / discount(F.col("rank"))).alias("dcg")
    )


def ndcg(
    data: DataFrame, k: int = 10, gains: str = "exponential", score: str = "score"
) -> DataFrame:
    """DCG over the ideal DCG: query_id, ndcg; null where the ideal is 0."""
    actual = dcg(data, k, gains, score)
    ideal = dcg(data, k, gains, "label").withColumnRenamed("dcg", "ideal")
    return actual.join(ideal, "query_id").select(
        "query_id", F.when(F.col("ideal") != 0, F.col("dcg") / F.col("ideal")).alias("ndcg")
    )


def average_ndcg(data: DataFrame, k: int = 10, score: str = "score") -> DataFrame:
    return ndcg(data, k, score=score).agg(F.avg("ndcg").alias("avg_ndcg"))


def delta_ndcg(
    data: DataFrame, k: int = 10, gains: str = "exponential", score: str = "score"
) -> DataFrame:
    """Change of NDCG when two documents swap places: query_id, doc_i, doc_j, delta.

    Only pairs that touch the best `k` can change anything, so the best k of a query (one short
    array) meet the query's documents; all other pairs are 0 and are not listed.
    """
    ranked = materialize(
        rank_within(
            data.select("query_id", "doc_id", "label", score), ["query_id"], _by(score)
        ).select(
            "query_id",
            "doc_id",
            "rank",
            gain(F.col("label"), gains).alias("g"),
            (1 / discount(F.col("rank"))).alias("w"),
        )
    )
    top = (
        ranked.filter(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "g", "w"))).alias("top"))
    )
    ideal = dcg(data, k, gains, "label").withColumnRenamed("dcg", "ideal")
    per_query = top.join(ideal, "query_id")
    pairs = skew_join(ranked, per_query, ["query_id"], salt_on=["doc_id"]).select(
        "query_id", "doc_id", "rank", "g", "w", "ideal", F.explode("top").alias("t")
    )
    change = F.abs((F.col("g") - F.col("t.g")) * (F.col("t.w") - F.col("w")))
    scaled = F.when(F.col("ideal") != 0, change / F.col("ideal")).otherwise(change)
    here, there = F.col("doc_id"), F.col("t.doc_id")
    # A pair inside the best k meets itself from both sides; a pair with one outsider is mirrored.
    both = F.when(
        F.col("rank") <= k, F.array(F.struct(here.alias("i"), there.alias("j")))
    ).otherwise(
        F.array(F.struct(here.alias("i"), there.alias("j")), F.struct(there.alias("i"), here.alias("j")))
    )
    return pairs.select("query_id", scaled.alias("delta"), F.explode(both).alias("p")).select(
        "query_id", F.col("p.i").alias("doc_i"), F.col("p.j").alias("doc_j"), "delta"
    )


def label_levels(cells: DataFrame) -> DataFrame:
    """0-based place of every distinct label of a query: query_id, label, level."""
    return rank_within(
        cells.select("query_id", "label").distinct(), ["query_id"], [F.col("label").asc()], "level"
    ).withColumn("level", F.col("level") - 1)


def pair_errors(data: DataFrame, score: str = "score") -> DataFrame:
    """Ordered pairs where (score_i <= score_j) equals (label_i > label_j): one row, pair_errors.

    The count splits into twice the pairs ordered against their labels, plus pairs tied in score
    only, plus pairs tied in label only. Ties are counted from group sizes. Pairs in wrong order
    are counted bit by bit of the label level: two levels differ first at exactly one bit, and
    there it suffices to count, in score order, the ones before every zero. So the work is rows
    times the bits of the number of distinct labels, never the number of pairs.
    """
    cells = materialize(
        data.groupBy("query_id", F.col(score).alias("score"), "label").agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    levels = materialize(label_levels(cells))
    bits = int(levels.agg(F.max("level")).first()[0] or 0).bit_length()

    def tied(key: str) -> DataFrame:
        sums = cells.groupBy("query_id", key).agg(
            F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same")
        )
        return sums.agg(
            F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2), F.lit(0)).cast("bigint").alias("c")
        )

    counts = tied("score").unionByName(tied("label"))
    if bits:
        leveled = skew_join(cells, levels, ["query_id", "label"], salt_on=["score"])
        bit = F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))
        split = (
            leveled.select("query_id", "score", "n", "level", bit.alias("bit"))
            .groupBy(
                "query_id",
                "bit",
                F.expr("shiftright(level, bit + 1)").alias("prefix"),
                "score",
            )
            .agg(
                F.sum(F.expr("n * (shiftright(level, bit) & 1)")).alias("ones"),
                F.sum(F.expr("n * (1 - (shiftright(level, bit) & 1))")).alias("zeros"),
            )
        )
        run = prefix_sum(
            split, ["query_id", "bit", "prefix"], [F.col("score").asc()], {"upto": F.col("ones")}
        )
        wrong = run.agg(
            (2 * F.coalesce(F.sum(F.col("zeros") * (F.col("upto") - F.col("ones"))), F.lit(0)))
            .cast("bigint")
            .alias("c")
        )
        counts = counts.unionByName(wrong)
    return counts.agg(F.sum("c").alias("pair_errors"))


def normalize_labels(data: DataFrame) -> DataFrame:
    """Labels replaced by five times their dense rank in the query."""
    levels = label_levels(data)
    ranked = skew_join(data, levels, ["query_id", "label"], salt_on=["doc_id"])
    return ranked.withColumn("label", (F.col("level") + 1) * 5.0).drop("level")


def split_by_query(data: DataFrame, share: float) -> DataFrame:
    """Mark rows of the first int(share * n) queries as validation: adds `part`."""
    queries = data.select("query_id").distinct()
    numbered = rank_within(queries, [], [F.col("query_id").asc()], "_q")
    n_valid = int(share * numbered.count())
    part = F.when(F.col("_q") <= n_valid, "valid").otherwise("train")
    marked = numbered.select("query_id", part.alias("part"))
    return lookup_join(data, marked, ["query_id"])


def lambda_gradient(
    data: DataFrame,
    score: str = "score",
    sigma: float = 1.0,
    k_delta: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Pairwise gradient per document: adds lambda.

    Documents of a query with equal label and score have the same gradient, so the sum runs over
    distinct (label, score) cells with their sizes. Queries of few cells list their pairs. In
    others the push is a smooth function of the difference of two scores, so crowded bins of scores
    meet through a fixed number of nodes (see `_near_pushes`), and pairs beyond _FAR are counted:
    work grows with cells x bits of the number of labels, never with pairs. `k_delta` weights
    each pair with its change of NDCG at that depth; off by default. `largest` bounds the rows of
    a query, when known. Scores are finite; a score or label that is missing leaves no gradient to
    its query.
    """
    if k_delta is not None:
        return _weighted_gradient(data, score, sigma, k_delta)
    cells = data.groupBy("query_id", "label", F.col(score).alias("h")).agg(
        F.count(F.lit(1)).alias("n")
    )

    def term(i: Column, j: Column) -> Column:
        sign = F.signum(i["label"] - j["label"])
        push = sigma / (1 + F.exp(sigma * (i["h"] - j["h"]) * sign))
        return j["n"] * sign * push

    values = ["label", "h", "n"]
    if largest is not None and largest <= limit(data.sparkSession, PAIR_BLOCK):
        # Every query is one block of pairs.
        sums = pairwise_sum(cells, ["query_id"], values, term, "lambda", largest)
    else:
        sums = _small_and_wide(materialize(cells.filter("query_id is not null")), sigma, values, term)
    sums = sums.select("query_id", "label", F.col("h").alias("_h"), "lambda")
    rows, on = data.withColumn("_h", F.col(score)), ["query_id", "label", "_h"]
    if largest is not None and largest <= rows_per_task(data):
        return rows.join(sums, on).drop("_h")
    return skew_join(rows, sums, on, salt_on=["doc_id"]).drop("_h")


# exp(-50) is 2e-22: a push beyond it can't be told from 0, nor its complement from 1.
_FAR = 50
# Nodes of a bin. The push has its next poles at +-i pi and bins have the width 1, so interpolation
# at p Chebyshev nodes errs by about 12.6^-p: 2e-18 for 16, less than the rounding of a double.
_NODES = 16
_ANGLES = [math.pi * (k + 0.5) / _NODES for k in range(_NODES)]
# Whole numbers up to here have a fraction that tells scores apart.
_WHOLE = float(1 << 50)


def _small_and_wide(cells: DataFrame, sigma: float, values: list[str], term: Callable) -> DataFrame:
    """Gradient per cell: query_id, label, h, lambda. Only queries of one block list their pairs."""
    block = limit(cells.sparkSession, PAIR_BLOCK)
    missing = F.bool_or(F.col("label").isNull() | F.col("h").isNull())
    wide = materialize(
        cells.groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("_n"), missing.alias("_missing"))
        .filter(F.col("_n") > block)
        .select("query_id", "_missing")
    )
    small = lookup_join(cells, wide.select("query_id"), ["query_id"], "left_anti")
    sums = pairwise_sum(small, ["query_id"], values, term, "lambda", block).select("query_id", "label", "h", "lambda")
    if wide.isEmpty():
        return sums
    many = lookup_join(cells, wide, ["query_id"])
    nothing = many.filter("_missing").select("query_id", "label", "h", F.lit(None).cast("double").alias("lambda"))
    found = _near_and_far(materialize(many.filter("not _missing").drop("_missing")), sigma)
    return sums.unionByName(nothing).unionByName(found)


def _near_and_far(cells: DataFrame, sigma: float) -> DataFrame:
    """Gradient per cell query_id, label, h, n, by bits of the label's level: two levels differ first
    at exactly one bit, so each pair of labels meets once, as the two sides of a bit and prefix."""
    levels = materialize(label_levels(cells))
    bits = int(levels.agg(F.max("level")).first()[0] or 0).bit_length()
    if not bits:
        return cells.select("query_id", "label", "h", F.lit(0.0).alias("lambda"))
    place = F.floor(F.col("h") * sigma).cast("bigint")
    leveled = materialize(
        skew_join(cells, levels, ["query_id", "label"], salt_on=["h"])
        .withColumn("bin", place)
        .withColumn("band", F.floor(F.col("bin") / _FAR).cast("bigint"))
    )
    sums = _near_pushes(leveled, sigma, bits)
    ends = leveled.agg(F.min("band").alias("low"), F.max("band").alias("high")).first()
    if ends.low is not None and ends.high - ends.low > 1:
        sums = sums.unionByName(_far_pushes(leveled, sigma, bits))
    return sums.groupBy("query_id", "label", "h").agg(F.sum("lambda").alias("lambda"))


def _chebyshev(k: int) -> Column:
    """Polynomial number k at the place `off` in its bin."""
    return F.cos(k * F.acos(2 * F.col("off") - 1))


def _near_pushes(leveled: DataFrame, sigma: float, bits: int) -> DataFrame:
    """Pushes of all pairs in the same or neighbouring bands: query_id, label, h, lambda per bit.

    Cells of one bin and side with more than _NODES scores are replaced by nodes: their weights
    carry the moments of the scores, and what the nodes receive is interpolated at the scores. Bins
    with fewer scores keep them. So a bin holds at most _NODES points and a band at most 2 x _FAR
    of such bins, and the pairs of points are never more than the pairs of cells.
    """
    by, bit = ["query_id", "bit", "prefix"], F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))
    at = [*by, "side", "bin"]
    sided = leveled.withColumn("bit", bit).select(
        "query_id", "bit", F.expr("shiftright(level, bit + 1)").alias("prefix"),
        F.expr("shiftright(level, bit) & 1").alias("side"), "bin", "band",
        (F.col("h") * sigma - F.col("bin")).alias("off"), "label", "h", "n",
    )
    points = materialize(sided.groupBy(*at, "band", "off").agg(F.sum("n").cast("double").alias("n")))
    moments = [F.sum(F.col("n") * _chebyshev(k)).alias(f"m{k}") for k in range(_NODES)]
    dense = materialize(
        points.filter(F.abs(F.col("bin")) < _WHOLE)
        .groupBy(*at, "band").agg(F.count(F.lit(1)).alias("_n"), *moments).filter(F.col("_n") > _NODES)
    )
    nodes = [
        F.struct(
            F.lit((math.cos(angle) + 1) / 2).alias("off"),
            reduce(add, [F.col(f"m{k}") * ((2 if k else 1) / _NODES * math.cos(k * angle)) for k in range(_NODES)]).alias("n"),
        )
        for angle in _ANGLES
    ]
    kept = lookup_join(points, dense.select(*at), at, "left_anti").withColumn("node", F.lit(False))
    made = dense.select(*at, "band", F.explode(F.array(*nodes)).alias("p")).select(
        *at, "band", "p.off", "p.n", F.lit(True).alias("node")
    )
    # A point meets its own band and the two beside it; in those it only stands as a partner.
    places = F.explode(F.array(*[F.struct((F.col("band") + s).alias("band"), F.lit(s == 0).alias("own")) for s in (-1, 0, 1)]))
    met = kept.unionByName(made).withColumn("_p", places).select(
        *at, "off", "n", "node", F.col("_p.band").alias("band"), F.col("_p.own").alias("own")
    )

    def term(i: Column, j: Column) -> Column:
        sign = F.signum((i["side"] - j["side"]).cast("double"))
        apart = (i["bin"] - j["bin"]) + (i["off"] - j["off"])
        return j["n"] * sign * (sigma / (1 + F.exp(apart * sign)))

    values = ["side", "bin", "off", "n", "node", "own"]
    near = materialize(pairwise_sum(materialize(met), [*by, "band"], values, term, "near", None, lambda i: i["own"]))
    terms = [
        ((2 if k else 1) / _NODES * F.sum(F.col("near") * _chebyshev(k))).alias(f"c{k}") for k in range(_NODES)
    ]
    curves = materialize(near.filter("node").groupBy(*at).agg(*terms))
    smooth = reduce(add, [F.col(f"c{k}") * _chebyshev(k) for k in range(_NODES)])
    found = near.filter("not node").select(*at, "off", F.col("near").alias("lambda"))
    return (
        lookup_join(sided, curves, at).select("query_id", "label", "h", smooth.alias("lambda"))
        .unionByName(
            skew_join(sided, found, [*at, "off"], salt_on=["label"]).select("query_id", "label", "h", "lambda")
        )
    )


def _far_pushes(leveled: DataFrame, sigma: float, bits: int) -> DataFrame:
    """Pushes of all pairs at least two bands apart: query_id, label, h, lambda.

    A cell is pushed up by each far row with a smaller label and a higher score, and down by each
    with a greater label and a lower score. Per bit and prefix one running sum in the order of
    bands counts the rows of the other side.
    """
    bit = F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))
    # One row per band and level; side 0 reads bands upwards, side 1 downwards.
    small = leveled.groupBy("query_id", "label", "level", "band").agg(F.sum("n").alias("n"))
    split = (
        small.select("*", bit.alias("bit"))
        .withColumn("one", F.expr("shiftright(level, bit) & 1"))
        .withColumn("prefix", F.expr("shiftright(level, bit + 1)"))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("pos", F.when(F.col("side") == 0, F.col("band")).otherwise(-F.col("band")))
        # Upwards a zero asks for ones below it, downwards a one asks for zeros above it.
        .withColumn("asks", F.col("one") == F.col("side"))
    )
    by = ["query_id", "side", "bit", "prefix"]
    moved = F.when(F.col("asks"), F.col("pos")).otherwise(F.col("pos") + 2)
    marks = split.groupBy(*by, moved.alias("pos")).agg(
        F.sum(F.when(~F.col("asks"), F.col("n")).otherwise(0)).alias("add")
    )
    run = materialize(prefix_sum(materialize(marks), by, [F.col("pos")], {"rows": F.col("add")}))
    asked = split.filter("asks").select("label", "band", *by, "pos")
    found = skew_join(asked, run.select(*by, "pos", "rows"), [*by, "pos"], salt_on=["label"])
    signed = F.when(F.col("side") == 0, -F.col("rows")).otherwise(F.col("rows"))
    pushes = materialize(found.groupBy("query_id", "label", "band").agg(F.sum(signed).alias("rows")))
    return skew_join(leveled, pushes, ["query_id", "label", "band"], salt_on=["h"]).select(
        "query_id", "label", "h", (F.col("rows") * sigma).alias("lambda")
    )


def _weighted_gradient(data: DataFrame, score: str, sigma: float, k: int) -> DataFrame:
    """Gradient with pairs weighted by the change of NDCG; only pairs touching the best k count."""
    deltas = materialize(delta_ndcg(data, k, "exponential", score))
    side = data.select("query_id", "doc_id", F.col("label").cast("double"), F.col(score).alias("h"))
    i = side.select("query_id", F.col("doc_id").alias("doc_i"), F.col("label").alias("y_i"), F.col("h").alias("h_i"))
    j = side.select("query_id", F.col("doc_id").alias("doc_j"), F.col("label").alias("y_j"), F.col("h").alias("h_j"))
    pairs = skew_join(deltas, i, ["query_id", "doc_i"], salt_on=["doc_j"])
    heavy = hot_keys(deltas, ["query_id", "doc_j"])
    pairs = skew_join(pairs, j, ["query_id", "doc_j"], salt_on=["doc_i"], heavy=heavy)
    sign = F.signum(F.col("y_i") - F.col("y_j"))
    push = sigma / (1 + F.exp(sigma * (F.col("h_i") - F.col("h_j")) * sign))
    sums = pairs.groupBy("query_id", F.col("doc_i").alias("doc_id")).agg(
        F.sum(sign * push * F.col("delta")).alias("lambda")
    )
    return data.join(sums, ["query_id", "doc_id"], "left").withColumn(
        "lambda", F.coalesce("lambda", F.lit(0.0))
    )


@dataclass
class LambdaRankModel:
    """Regression trees as plain nodes, summed with a learning rate."""

    learning_rate: float
    trees: list[dict] = field(default_factory=list)

    def predict(self, features: Column) -> Column:
        """Score as one Column: every tree is a nested CASE over the feature array."""
        if not self.trees:
            return F.lit(0.0)
        values = F.array(*[tree_value(tree, features) for tree in self.trees])
        return F.aggregate(values, F.lit(0.0), lambda sum_, x: sum_ + x * self.learning_rate)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per tree: tree_no, learning_rate, tree."""
        rows = [(i, self.learning_rate, json.dumps(t)) for i, t in enumerate(self.trees)]
        return spark.createDataFrame(rows, "tree_no int, learning_rate double, tree string")

    @staticmethod
    def from_table(table: DataFrame) -> LambdaRankModel:
        # One row per boosting round.
        rows = table.orderBy("tree_no").collect()
        return LambdaRankModel(
            rows[0].learning_rate if rows else 0.0, [json.loads(r.tree) for r in rows]
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LambdaRankModel:
        return LambdaRankModel.from_table(spark.read.parquet(path))


def tree_nodes(node) -> dict:
    """Nodes of a fitted Spark tree."""
    if node.subtreeDepth() == 0:
        return {"value": node.prediction()}
    return {
        "feature": node.split().featureIndex(),
        "threshold": node.split().threshold(),
        "left": tree_nodes(node.leftChild()),
        "right": tree_nodes(node.rightChild()),
    }


def tree_value(tree: dict, features: Column) -> Column:
    if "value" in tree:
        return F.lit(float(tree["value"]))
    test = F.get(features, F.lit(tree["feature"])) <= tree["threshold"]
    return F.when(test, tree_value(tree["left"], features)).otherwise(
        tree_value(tree["right"], features)
    )


def _binned_tree(rows: DataFrame, depth: int, max_bins: int) -> dict:
    learner = DecisionTreeRegressor(
        featuresCol="vector",
        labelCol="lambda",
        predictionCol="_tree",
        maxDepth=depth,
        maxBins=max_bins,
        minInstancesPerNode=1,
        seed=0,
    )
    vectors = rows.select("lambda", array_to_vector("features").alias("vector"))
    return tree_nodes(learner.fit(vectors)._java_obj.rootNode())


def _node(tree: dict, features: Column) -> Column:
    """Number of the leaf that a row falls into; node k has the children 2k and 2k + 1."""
    if "value" in tree:
        return F.lit(tree["number"])
    test = F.get(features, F.lit(tree["feature"])) <= tree["threshold"]
    return F.when(test, _node(tree["left"], features)).otherwise(_node(tree["right"], features))


def _best_splits(rows: DataFrame, min_rows: int, one_task: bool) -> dict[int, tuple[int, float]]:
    """Feature and threshold of the best split of every node that has one; rows: node, target, features.

    One cell per (node, feature, value) and its running sums in the order of values; nothing is
    binned. `one_task` says that a task may sort all rows of a node.
    """
    long = rows.select("node", "target", F.posexplode("features").alias("feature", "value"))
    cells = long.filter("value is not null").groupBy("node", "feature", "value").agg(
        F.sum("target").alias("s"), F.count(F.lit(1)).alias("n")
    )
    if one_task:
        upto = Window.partitionBy("node", "feature").orderBy("value")
        running = upto.rowsBetween(Window.unboundedPreceding, 0)
        summed = cells.select(
            "node", "feature", "value", F.lead("value").over(upto).alias("next"),
            F.sum("s").over(running).alias("sl"), F.sum("n").over(running).alias("nl"),
        )
    else:
        cells = materialize(cells)
        summed = prefix_sum(
            cells, ["node", "feature"], [F.col("value")], {"sl": F.col("s"), "nl": F.col("n")}
        )
        # Behind its last value a feature has no split; the next value is looked up for the best ones.
        last = materialize(cells.groupBy("node", "feature").agg(F.max("value").alias("last")))
        summed = lookup_join(summed, last, ["node", "feature"]).withColumn(
            "next", F.when(F.col("value") < F.col("last"), F.col("value"))
        )
    # A row per node: at most 2^depth.
    totals = rows.groupBy("node").agg(F.sum("target").alias("all_s"), F.count(F.lit(1)).alias("all_n"))
    known = summed.join(F.broadcast(totals), "node")
    sr, nr = F.col("all_s") - F.col("sl"), F.col("all_n") - F.col("nl")
    gain = F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr
    # Sums come in any order, so gains are compared at six digits; then feature and value decide.
    place = F.struct(F.round("gain", 6).alias("g"), -F.col("feature"), -F.col("value"))
    best = (
        known.filter((F.col("nl") >= min_rows) & (nr >= min_rows) & F.col("next").isNotNull())
        .withColumn("gain", gain)
        .filter(F.col("gain") - F.col("all_s") * F.col("all_s") / F.col("all_n") > 1e-9)
        .groupBy("node")
        .agg(F.max_by(F.struct("feature", "value", "next"), place).alias("b"))
        .select("node", "b.*")
    )
    if not one_task:
        best = materialize(best)
        chosen = F.broadcast(best.select("node", "feature", F.col("value").alias("_at")))
        after = cells.join(chosen, ["node", "feature"]).filter(F.col("value") > F.col("_at"))
        after = after.groupBy("node").agg(F.min("value").alias("next"))
        best = best.drop("next").join(F.broadcast(after), "node", "left")
    middle = (F.col("value") + F.col("next")) / 2
    return {r.node: (r.feature, r.middle) for r in best.select("node", "feature", middle.alias("middle")).collect()}


def exact_tree(rows: DataFrame, target: str, depth: int, min_rows: int = 1) -> dict:
    """Regression tree of at most `depth` levels with the exact best splits by squared error.

    `rows` has `features` (array<double>, missing values allowed) and the target. Of equal splits
    the one of the first feature and the smallest value is taken; the threshold is the middle to
    the next value in the node. Rows whose value is missing go right. Returns nodes as `tree_value` reads them.
    """
    rows = rows.select("features", F.col(target).alias("target"))
    one_task = rows.count() <= rows_per_task(rows)
    root: dict = {"number": 1, "value": 0.0}
    leaves = {1: root}
    for _ in range(depth):
        placed = rows.withColumn("node", _node(root, F.col("features")))
        # A leaf without a split is looked at again; its rows are the same, so it stays one.
        splits = _best_splits(placed, min_rows, one_task)
        for number, (feature, threshold) in splits.items():
            node = leaves.pop(number)
            children = [{"number": 2 * number + i, "value": 0.0} for i in (0, 1)]
            node.clear()
            node.update(feature=feature, threshold=threshold, left=children[0], right=children[1])
            leaves.update({c["number"]: c for c in children})
        if not splits:
            break
    means = rows.groupBy(_node(root, F.col("features")).alias("node")).agg(F.avg("target").alias("mean"))
    for r in means.collect():
        leaves[r.node]["value"] = r.mean
    for leaf in leaves.values():
        del leaf["number"]
    return root


Normalizer = Callable[[DataFrame], DataFrame]


def fit(
    data: DataFrame,
    n_estimators: int,
    learning_rate: float = 0.01,
    sigma: float = 1.0,
    start_depth: int = 3,
    valid_share: float = 0.2,
    normalize: Normalizer = normalize_labels,
    k_delta: int | None = None,
    max_bins: int | None = None,
    metrics: bool = True,
    metrics_k: int = 5,
) -> tuple[LambdaRankModel, list[dict]]:
    """Boost trees on the ranking gradient of the training queries.

    Each round fits one tree of depth `start_depth` with exact splits (with `max_bins`, splits at
    the borders of that many bins) and adds it, scaled, to the scores of all rows. Returns the model and, when asked, one record per round with pair errors and NDCG of
    both parts and the length of the gradient.
    """
    rows = normalize(split_by_query(data, valid_share))
    rows = rows.select("part", "query_id", "doc_id", "label", "features").withColumn("h", F.lit(0.0))
    # Rows are not gathered by query: a large query would fill one task.
    rows = materialize(rows)
    largest = rows.groupBy("query_id").count().agg(F.max("count")).first()[0] or 0
    model = LambdaRankModel(learning_rate)
    history: list[dict] = []
    for number in range(n_estimators):
        train = rows.filter(F.col("part") == "train")
        gradient = materialize(
            lambda_gradient(train, "h", sigma, k_delta, largest).select("lambda", "features")
        )
        tree = exact_tree(gradient, "lambda", start_depth) if max_bins is None else _binned_tree(
            gradient, start_depth, max_bins
        )
        model.trees.append(tree)
        step = tree_value(tree, F.col("features")) * learning_rate
        rows = materialize(rows.withColumn("h", F.col("h") + step))
        if metrics:
            history.append(_round_metrics(rows, gradient, number, metrics_k))
    return model, history


def _round_metrics(rows: DataFrame, gradient: DataFrame, number: int, k: int) -> dict:
    record = {"iteration": number}
    for part in ("train", "valid"):
        half = rows.filter(F.col("part") == part)
        record[f"errors_{part}"] = pair_errors(half, "h").first()[0]
        record[f"ndcg_{part}"] = average_ndcg(half, k, "h").first()[0]
    record["gradient_norm"] = gradient.agg(
        F.sqrt(F.sum(F.col("lambda") * F.col("lambda")))
    ).first()[0]
    return record


def predict(data: DataFrame, model: LambdaRankModel, name: str = "score") -> DataFrame:
    return data.withColumn(name, model.predict(F.col("features")))


def submission(scored: DataFrame, score: str = "score") -> DataFrame:
    """Documents of every query by predicted score: query_id, doc_id, rank."""
    return rank_within(
        scored.select("query_id", "doc_id", score),
        ["query_id"],
        [F.round(score, 9).desc(), F.col("doc_id").asc()],
    ).select("query_id", "doc_id", "rank")
