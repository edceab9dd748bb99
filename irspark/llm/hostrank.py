"""URL filters by link-graph propagation.

Rules judge the urls that they fit. For all others, trust flows from hosts with allowed pages along
host edges, and distrust flows from hosts with blocked pages against them; both are personalised
PageRank, whose seeds are the numbers of allowed and blocked pages. Scores are in pages, and a host
is blocked if its share of distrust is above a threshold.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.skew import lookup_join

ROUNDS, DAMPING, THRESHOLD = 12, 0.85, 0.5
# Rounds between two written tables.
_WRITTEN_EVERY = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """Host after the first `://`, A-Z lower-cased; empty without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path that begins like its own.

    `rules` is a short list given by hand; of rules of one length the first in order wins.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = (host == name) | F.endswith(host, F.lit(f".{name}"))
        found = F.when(fits & F.startswith(path, F.lit(slash + rest)), F.lit(rule)).otherwise(found)
    return found


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, n: links between different hosts, and between a host and its parent domains.

    A subdomain is part of its parents' sites (up to two labels), so they vouch for each other.
    Links are counted per pair of hosts before anything is shuffled.
    """
    held = pages.select(host_of(F.col(url)).alias("src"), F.coalesce(html, F.lit("")).alias("html")).filter("src <> ''")
    link = F.explode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("link")
    # Other links stay on the host; `//host/...` takes the page's scheme.
    away = held.select("src", link).filter("link rlike '^([A-Za-z][A-Za-z0-9+.-]*:)?//'")
    target = host_of(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), "link")).otherwise(F.col("link")))
    links = away.select("src", target.alias("dst")).filter("dst <> '' and dst <> src")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    hosts = held.select("src").distinct()
    labels = F.split("src", "\\.")
    parents = F.transform(
        F.sequence(F.lit(2), F.size(labels) - 1),
        lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    owned = hosts.filter(F.size(labels) > 2).select("src", F.explode(parents).alias("dst"))
    both = owned.unionByName(owned.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    return links.unionByName(both.withColumn("n", F.lit(1).cast("bigint"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """host, trust, distrust from edges (src, dst, n) and seeds (host, trust, distrust).

    Trust goes from src to dst by the share of src's links, distrust from dst to src by the share
    of dst's incoming links. Hosts without a way on lose their mass, which changes scores only by
    a common factor. Both run in one pass over the edges per round.
    """
    out = edges.groupBy(F.col("src").alias("host")).agg(F.sum("n").alias("total"))
    into = edges.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("total"))
    ahead = lookup_join(edges.withColumnRenamed("src", "host"), materialize(out), ["host"]).select(
        "host", F.col("dst").alias("to"), (F.col("n") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
    back = lookup_join(edges.withColumnRenamed("dst", "host"), materialize(into), ["host"]).select(
        "host", F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("n") / F.col("total")).alias("d"))
    steps = materialize(ahead.unionByName(back).groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")))
    names = steps.select("host").unionByName(seeds.select("host")).distinct()
    start = names.join(seeds, "host", "left").na.fill(0.0)
    start = materialize(start)
    n = start.count()
    score = start
    for i in range(rounds):
        moved = lookup_join(steps, score, ["host"], table_rows=n).select(
            F.col("to").alias("host"), (damping * F.col("t") * F.col("trust")).alias("trust"),
            (damping * F.col("d") * F.col("distrust")).alias("distrust"))
        own = start.select("host", *[((1 - damping) * F.col(c)).alias(c) for c in ("trust", "distrust")])
        score = own.unionByName(moved).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if (i + 1) % _WRITTEN_EVERY == 0:
            score = materialize(score)
    return score


def judge(pages: DataFrame, rules: Mapping[str, str], threshold: float = THRESHOLD, page_id: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page.

    `rules` maps host/path prefixes to allow or block. Without a rule the verdict is block if
    distrust / (trust + distrust) is above the threshold, and allow otherwise; a host without any
    score, or a url without a host, is allowed. A null url or one without `://` has an empty host
    and path; null html has no links. Repeated rows are judged alike (and count as pages); columns
    beyond the three are not read; an empty table gives an empty one.
    """
    parsed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    lookup = reduce(lambda c, r: F.when(F.col("rule") == r, F.lit(rules[r])).otherwise(c), rules, F.lit(None).cast("string"))
    ruled = parsed.withColumn("ruled", lookup)
    seeds = ruled.filter("ruled is not null").groupBy("host").agg(
        F.sum(F.when(F.col("ruled") == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("distrust"))
    scores = materialize(propagate(materialize(host_edges(pages, url, html)), materialize(seeds)))
    found = lookup_join(ruled, scores, ["host"], "left").na.fill(0.0, ["trust", "distrust"])
    blocked = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce("ruled", F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                        F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))
