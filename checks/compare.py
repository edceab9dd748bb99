"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    got = spark_df.toArrow()
    left_cols = list(got.column_names)
    left = rows_of(left_cols, list(zip(*[c.to_pylist() for c in got.columns])) if left_cols else [])
    cursor = con.execute(sql)
    right_cols = [d[0] for d in cursor.description]
    right = rows_of(right_cols, cursor.fetchall())
    for name, kind in ((d[0], str(d[1])) for d in cursor.description):
        if kind.startswith(("DECIMAL", "HUGEINT")):
            return f"column {name} is {kind}"
    if sorted(left_cols) != sorted(right_cols):
        return f"columns {sorted(left_cols)} != {sorted(right_cols)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    if not left:
        return "no rows"
    return None
