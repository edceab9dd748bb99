"""TF-IDF: vocabulary, smoothed idf, L2-normalised weights and query-document scores.

A text's terms are counted inside its row, so texts never move. Long tables replace the sparse
matrices: one row per (document, field, term).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from irspark.functions.binding import let
from irspark.functions.text import fold_tokens, remove_stop_words
from irspark.plans.lineage import materialize
from irspark.plans.ordering import rows_per_task, top_rows
from irspark.plans.skew import broadcast_rows, fits_broadcast, hot_keys, lookup_join, skew_join


def sparse_rows(
    texts: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    mode: str = "words",
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """One sparse row per text: keys, cells (array of term, tf), terms in order.

    Terms are counted inside the text's own row: the sorted tokens are cut where the term changes.
    Write the result once to fit and to transform the same texts with one tokenisation.
    """
    tokens = remove_stop_words(fold_tokens(F.col(text), mode), stop_words)

    def counted(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(words, i).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(words)) - i).cast("bigint").alias("tf"),
                ),
            ),
        )

    cells = let(F.sort_array(tokens), lambda words: F.when(F.size(words) > 0, counted(words)))
    return texts.select(*keys, cells.alias("cells"))


def term_counts(
    texts: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    mode: str = "words",
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Occurrences of every term per text: keys, term, tf. Takes texts, one row per key, or sparse rows."""
    rows = texts if "cells" in texts.columns else sparse_rows(texts, keys, text, mode, stop_words)
    return rows.select(*keys, F.explode("cells").alias("c")).select(*keys, "c.term", "c.tf")


def fit_vocabulary(
    texts: DataFrame,
    max_features: int | None = None,
    text: str = "text",
    mode: str = "words",
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Most frequent terms of the corpus: term, tf (corpus count), df (documents).

    Takes texts or sparse rows; counts are summed in each task before they move.
    """
    counts = term_counts(texts, (), text, mode, stop_words)
    totals = counts.groupBy("term").agg(
        F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df")
    )
    return top_rows(totals, [F.col("tf").desc(), F.col("term")], max_features)


def smooth_idf(df: Column, n: Column) -> Column:
    return F.log((n + 1) / (df + 1)) + 1


def fit_idf(
    texts: DataFrame,
    max_features: int | None = None,
    text: str = "text",
    mode: str = "words",
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Vocabulary with idf: term, tf, df, idf.

    The fitted table is written once; using it never counts the corpus again.
    """
    n = texts.agg(F.count(F.lit(1))).scalar()
    vocabulary = fit_vocabulary(texts, max_features, text, mode, stop_words)
    return materialize(vocabulary.withColumn("idf", smooth_idf(F.col("df"), n)))


def transform(
    texts: DataFrame,
    idf: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    mode: str = "words",
    stop_words: Sequence[str] = (),
    vocabulary_rows: int | None = None,
) -> DataFrame:
    """Weights tf x idf, scaled to unit length per text: keys, term, tf, weight.

    Takes texts, one row per key, or sparse rows. `vocabulary_rows` bounds the vocabulary when
    known (the cap it was fitted with); it decides between a broadcast and a join that splits
    frequent terms, which the fitted document counts name.
    """
    counts = term_counts(texts, keys, text, mode, stop_words)
    known = idf.select("term", "idf")
    fits = fits_broadcast(known) if vocabulary_rows is None else vocabulary_rows <= broadcast_rows(known)
    if fits:
        known = counts.join(F.broadcast(known), "term")
    else:
        rows = rows_per_task(counts)
        heavy = idf.filter(F.col("df") > rows).select("term", F.ceil(F.col("df") / rows).cast("int").alias("_parts"))
        known = skew_join(counts, known, ["term"], salt_on=list(keys), heavy=heavy)
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(*keys)))
    return known.select(*keys, "term", "tf", (raw / norm).alias("weight"))


def lookup(requests: DataFrame, weights: DataFrame, pages: DataFrame) -> DataFrame:
    """Weight of (doc_id, term) requests: null for an unknown page, 0 for an unknown term.

    Requests are written once; if their terms are few, weights of other terms never move.
    """
    requests = materialize(requests)
    asked = requests.withColumn("_term", F.lower(F.trim("term")))
    terms = materialize(asked.select("_term").distinct())
    present = pages.select("doc_id", F.lit(0.0).alias("_zero"))
    known = weights.select("doc_id", F.col("term").alias("_term"), "weight")
    if fits_broadcast(terms):
        known = known.join(F.broadcast(terms), "_term", "left_semi")
    heavy = hot_keys(requests, ["doc_id"])
    marked = skew_join(asked, present, ["doc_id"], "left", heavy=heavy)
    return (
        skew_join(marked, known, ["doc_id", "_term"], "left", heavy=heavy)
        .withColumn("weight", F.coalesce("weight", "_zero"))
        .drop("_term", "_zero")
    )


def query_tokens(queries: DataFrame, lower: bool = True) -> DataFrame:
    """Words of every query in its own row: query_id, tokens."""
    query = F.lower("query") if lower else F.col("query")
    words = F.filter(F.split(query, r"\s+"), lambda w: w != "")
    return queries.select("query_id", words.alias("tokens"))


def score(
    queries: DataFrame,
    candidates: DataFrame,
    weights: DataFrame,
    pages: DataFrame,
    fields: Sequence[str] = (),
    lower: bool = True,
) -> DataFrame:
    """Sum of the weights of all query words, repeated words counting again.

    Returns query_id, doc_id, [field,] score; a candidate whose page is unknown scores null, one
    without any matching term scores 0. Weights are cut to the query vocabulary before they move.
    """
    keys = ["query_id", "doc_id"] + (["field"] if fields else [])
    words = query_tokens(queries, lower)
    pairs = candidates.select("query_id", "doc_id")

    asked = lookup_join(pairs, words, ["query_id"]).select(
        "query_id", "doc_id", F.explode("tokens").alias("term")
    )
    terms = words.select(F.explode("tokens").alias("term")).distinct()
    used = lookup_join(weights, terms, ["term"], "left_semi")
    # A (document, term) pair is asked often only if its document is a candidate of many queries.
    heavy = hot_keys(pairs, ["doc_id"])
    hits = skew_join(asked, used, ["doc_id", "term"], salt_on=["query_id"], heavy=heavy).select(
        *keys, F.col("weight").alias("score")
    )

    present = pages.select("doc_id", F.lit(0.0).alias("score"))
    base = skew_join(pairs, present, ["doc_id"], "left", salt_on=["query_id"], heavy=heavy)
    if fields:
        base = base.withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))
    return base.select(*keys, "score").unionByName(hits).groupBy(*keys).agg(
        F.sum("score").alias("score")
    )


def score_record(scores: DataFrame) -> DataFrame:
    """Field scores gathered per query and document: query_id, doc_id, scores map."""
    return scores.groupBy("query_id", "doc_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "score")))).alias("scores")
    )
