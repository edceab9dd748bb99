"""Sizes that decide between plans. All can be changed through the session configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Rows of one key that a single task may sort or join before the key is split.
ROWS_PER_TASK = ("spark.irspark.rowsPerTask", 2_000_000)
# Rows of a table that may be broadcast once they have been counted.
BROADCAST_ROWS = ("spark.irspark.broadcastRows", 1_000_000)
# Bytes of such a table, by the widths of its columns; the driver holds it while it is sent.
BROADCAST_BYTES = ("spark.irspark.broadcastBytes", 8 * 1024 * 1024)
# Rows that a single sorted top-k task may hold.
TOP_K_ROWS = ("spark.irspark.topKRows", 100_000)
# Rows in one block of the pairwise kernel.
PAIR_BLOCK = ("spark.irspark.pairBlock", 1_000)
# Edges in one cell of a small graph.
CELL_EDGES = ("spark.irspark.cellEdges", 500_000)
# Values of sessions packed in one row that resamples draw from.
DRAW_ROWS = ("spark.irspark.drawRows", 1_000_000)
# Bytes of query vectors held by every worker at once.
VECTOR_BYTES = ("spark.irspark.vectorBytes", 64 * 1024 * 1024)


def limit(spark: SparkSession, setting: tuple[str, int]) -> int:
    key, default = setting
    return int(spark.conf.get(key, str(default)))
