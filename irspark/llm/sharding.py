"""Shards by rendezvous hashing: every record goes to the shard with its highest score.

The score of a record on a shard depends on the record's key, the shard's number and the shard's
weight alone: -weight / ln(u), with u a hash in (0, 1). A shard that is added can only win
records for itself, one that is removed only gives up its own, and a heavier shard wins in
proportion to its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.ordering import prefix_sum

# Hash digits used, 13 hexadecimal digits are 52 bits and fit a double.
_DIGITS = 13
# Rows that are numbered in one group.
_ROWS_PER_RANGE = 1_000
# Repeats of one row that are listed at once.
_REPEATS = 4_096


def hash_unit(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts, the same in every engine."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**_DIGITS))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard (from 0) that wins the key; a null key is one key like any other.

    Shards of weight 0 win nothing; of equal scores the lowest number wins.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights are 0 or more, and some are above 0")
    name = F.coalesce(key.cast("string"), F.lit(""))
    scores = [
        F.struct((-F.lit(float(w)) / F.log(hash_unit(name, F.lit(str(i))))).alias("score"), F.lit(-i).alias("i"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    return (-(F.greatest(*scores) if len(scores) > 1 else scores[0])["i"]).cast("int")


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """Add the shard of every row; no shuffle. A column that is named like it is replaced."""
    return docs.withColumn(name, shard_of(docs[key], weights))


def number(rows: DataFrame, shard: str = "shard", name: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without a gap, in an order given by their values.

    Equal rows are counted first and listed again at the end, as they get consecutive numbers
    whichever comes first. The rest is cut into equal ranges of a hash of the whole row; only
    sums of ranges are added up, so no shard passes through one task. An empty table stays empty.
    A column that is named like the number is replaced.
    """
    rows = rows.drop(name)
    columns = rows.columns
    counted = materialize(
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_h", F.shiftrightunsigned(F.xxhash64(*columns), 33))
    )
    total = counted.agg(F.count(F.lit(1))).first()[0]
    # The shards' rows are spread alike over the hash, so a range holds about as many of each.
    ranges = max(1, total // _ROWS_PER_RANGE)
    counted = counted.withColumn("_range", F.shiftright(F.col("_h") * F.lit(ranges).cast("bigint"), 31))
    sums = counted.groupBy(shard, "_range").agg(F.sum("_n").alias("_rows"))
    upto = prefix_sum(sums, [shard], [F.col("_range")], {"_upto": F.col("_rows")})
    starts = upto.select(F.col(shard).alias("_shard"), F.col("_range").alias("_of"),
                         (F.col("_upto") - F.col("_rows")).alias("_start"))
    inside = prefix_sum_local(counted, [shard, "_range"], ["_h", *columns], "_n")
    same = F.col(shard).eqNullSafe(F.col("_shard")) & (F.col("_range") == F.col("_of"))
    first = F.col("_start") + F.col("_before")
    # Two steps, so that the repeats of a very frequent row are never one array.
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / _REPEATS)))
    last = F.least(F.col("_n"), (F.col("_block") + 1) * _REPEATS) - 1
    repeat = F.explode(F.sequence(F.col("_block") * _REPEATS, last))
    return (
        inside.join(starts, same)
        .select(*columns, "_n", first.alias("_first"), block.alias("_block"))
        .select(*columns, "_first", repeat.alias("_i"))
        .select(*columns, (F.col("_first") + F.col("_i")).alias(name))
    )


def prefix_sum_local(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Sum of `value` over the rows before, in groups that are small by construction."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum(value).over(w), F.lit(0)))


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards of documents by their id: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: bytes of the text in UTF-8 (null: none) and one more; text_crc32: of those bytes;
    grown_shard: the shard if there were one more. Rows without an id share one key. Repeated
    rows each get a slot. Only these columns are read; an empty table gives an empty one.
    """
    raw = F.coalesce(docs[text], F.lit("")).cast("binary")
    narrow = docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    narrow = assign(narrow, [1.0] * shards)
    numbered = number(narrow)
    placed = assign(numbered, [1.0] * (shards + 1), name="grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
