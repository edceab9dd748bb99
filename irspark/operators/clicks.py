"""Click model: relevance of a url for a query from session logs.

A session row holds query, urls (by position) and clicks (1-based positions as logged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def click_events(sessions: DataFrame) -> DataFrame:
    """One row per counted event: query, url, examined, attracted, satisfied.

    Positions up to the largest click are examined, every logged click attracts, the last logged
    click satisfies. Sessions without clicks add nothing.
    """
    last = F.array_max("clicks")
    seen = F.transform(F.slice("urls", F.lit(1), F.coalesce(last, F.lit(0))), lambda u, i: F.struct(
        u.alias("url"), (i + 1).alias("pos")
    ))
    rows = sessions.filter(F.size("clicks") > 0).select(
        "query", "clicks", F.element_at("clicks", -1).alias("_last"), F.explode(seen).alias("s")
    )
    logged = F.size(F.filter("clicks", lambda c: c == F.col("s.pos")))
    return rows.select(
        "query",
        F.col("s.url").alias("url"),
        logged.cast("bigint").alias("attracted"),
        (F.col("s.pos") == F.col("_last")).cast("bigint").alias("satisfied"),
    )


def dbn_counts(sessions: DataFrame) -> DataFrame:
    """Counters per (query, url): a_d examined, a_n attracted, s_n satisfied."""
    return click_events(sessions).groupBy("query", "url").agg(
        F.count(F.lit(1)).alias("a_d"),
        F.sum("attracted").alias("a_n"),
        F.sum("satisfied").alias("s_n"),
    )


def dbn(sessions: DataFrame) -> DataFrame:
    """Counters with smoothed relevance: attraction times satisfaction."""
    attraction = (F.col("a_n") + 1) / (F.col("a_d") + 2)
    satisfaction = (F.col("s_n") + 1) / (F.col("a_n") + 2)
    return dbn_counts(sessions).withColumn("rel", attraction * satisfaction)


def top_for_query(model: DataFrame, query: str) -> DataFrame:
    """Urls of one query, most relevant first."""
    return (
        model.filter(F.col("query") == query)
        .select("url", "rel")
        .orderBy(F.round("rel", 12).desc(), "url")
    )
