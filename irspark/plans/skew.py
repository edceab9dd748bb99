"""Equi joins and groupings that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from irspark.plans.limits import BROADCAST_BYTES, BROADCAST_ROWS, ROWS_PER_TASK, limit

# Parts over which an outer join spreads rows whose key is null.
NULL_PARTS = 4096
# Bytes of a row besides its values, and of values by type.
_ROW_BYTES = 16
_WIDTHS = {"bigint": 8, "int": 8, "double": 8, "boolean": 8, "string": 24, "binary": 24}


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Keys with more than `rows` rows, and the number of parts each should be cut into.

    At most total/rows keys can qualify, so the result is small enough to broadcast.
    """
    rows = rows or limit(df.sparkSession, ROWS_PER_TASK)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows)
        .select(*keys, F.ceil(F.col("_n") / rows).cast("int").alias("_parts"))
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows: int | None = None,
    salt_on: Sequence[str] | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join `left`, which may have hot keys, with `right`, which has few rows per key.

    Rows of a hot key are spread over several parts by a hash of the row (or of `salt_on`), and
    the matching right rows are repeated once per part. Other keys keep part 0. `heavy` names the
    hot keys, or hot values of some of the key columns, when a cheaper table than `left` tells.
    """
    on = list(on)
    heavy = F.broadcast(hot_keys(left, on, rows) if heavy is None else heavy)
    by = [c for c in heavy.columns if c != "_parts"]
    spread = list(salt_on or [c for c, t in left.dtypes if "map<" not in t])
    row_hash = F.xxhash64(*[F.col(c) for c in spread])
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    # Rows without a key match nothing; any salt will do, so they are spread as well.
    salt = (
        F.when(F.col("_parts").isNotNull(), F.pmod(row_hash, F.col("_parts").cast("bigint")))
        .when(no_key, F.pmod(row_hash, F.lit(NULL_PARTS)))
        .otherwise(F.lit(0))
        .cast("int")
    )
    salted = left.join(heavy, by, "left").withColumn("_salt", salt).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    repeated = right.join(heavy, by, "left").withColumn("_salt", copies).drop("_parts")
    return salted.join(repeated, on + ["_salt"], how).drop("_salt")


def broadcast_rows(table: DataFrame) -> int:
    """Rows of the table that may be broadcast: a bound of rows and one of bytes.

    Strings and other values of no fixed size count with the size of a short one.
    """
    width = _ROW_BYTES + sum(_WIDTHS.get(kind, 64) for _, kind in table.dtypes)
    spark = table.sparkSession
    return min(limit(spark, BROADCAST_ROWS), limit(spark, BROADCAST_BYTES) // width)


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value in a row, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        inner = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        return reduce(add, [_bytes(value[f.name], f.dataType) for f in kind.fields], F.lit(8))
    elif isinstance(kind, T.ArrayType) and kind.elementType.simpleString() in _WIDTHS.keys() - {"string", "binary"}:
        inner = 8 * F.size(value)
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        inner = 4 * F.octet_length(F.to_json(value))
    else:
        return F.lit(8)
    return 8 + F.greatest(F.coalesce(inner, F.lit(0)), F.lit(0))


def fits_broadcast(table: DataFrame) -> bool:
    """Whether the table may be broadcast, by its counted rows, then by the bytes of these few rows."""
    if table.count() > broadcast_rows(table):
        return False
    if all(kind in _WIDTHS and kind not in ("string", "binary") for _, kind in table.dtypes):
        return True
    sizes = [_bytes(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields]
    total = table.agg(F.sum(reduce(add, sizes, F.lit(_ROW_BYTES)).cast("bigint"))).first()[0]
    return (total or 0) <= limit(table.sparkSession, BROADCAST_BYTES)


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    table_rows: int | None = None,
) -> DataFrame:
    """Join with a lookup table (one row per key): broadcast when its counted size allows.

    `table_rows` is a proven upper bound for the rows of a table of numbers and short keys;
    without one its rows and bytes are counted.
    """
    fits = fits_broadcast(table) if table_rows is None else table_rows <= broadcast_rows(table)
    if fits:
        return left.join(F.broadcast(table), list(on), how)
    return skew_join(left, table, on, how)
