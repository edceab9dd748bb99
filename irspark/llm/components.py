"""Connected components by distributed union-find.

Edges are turned by two steps in turn until all that is left are stars. The large step links every larger
neighbour of a node to the smallest node around it, the small step every smaller neighbour and the
node itself. Both keep the components, and leave stars around the smallest node of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.skew import lookup_join


def _joined(edges: DataFrame, nodes: DataFrame, bound: int) -> DataFrame:
    """Edges with the smallest neighbour of `u`; hubs are split beyond the broadcast size."""
    return lookup_join(edges, nodes, ["u"], table_rows=bound)


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges (u, v), and of nodes that keep them from being stars with a `v` in the middle."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = edges.select(F.explode(ends).alias("end")).groupBy("end.node").agg(F.sum("end.up").alias("ups"), F.count(F.lit(1)).alias("n"))
    n, others = nodes.agg(F.sum("ups"), F.count_if((F.col("ups") > 0) & (F.col("n") > 1))).first()
    return n or 0, others


def components(links: DataFrame) -> DataFrame:
    """From links (a, b): every linked node with the smallest node of its component (node, root).

    Links may repeat, come in both directions or lead to themselves; the values have an order. A
    node whose only links lead to itself is its own root. No links give an empty table.
    """
    a, b = F.col("a"), F.col("b")
    alone = links.filter(a == b).select(a.alias("node"), b.alias("root")).distinct()
    edges = materialize(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while True:
        n, others = _state(edges)
        # In stars every node but the middle has one edge, and the middle is the smallest.
        if others == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _joined(both.filter("v > u"), least, 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _joined(large, least, 2 * n).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.filter("u <> v").distinct())
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    return found.unionByName(alone.join(found.select("node"), "node", "left_anti"))
