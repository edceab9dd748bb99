"""Image preparation, feature vectors from a supplied model, nearest vectors by cosine distance."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from irspark.plans.limits import VECTOR_BYTES, limit
from irspark.plans.lineage import materialize
from irspark.plans.ordering import top_within
from irspark.plans.skew import fits_broadcast, lookup_join, skew_join

# Workers get the functions of this module with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Mean blue, green and red of the training images of the feature model.
CHANNEL_MEANS = (103.939, 116.779, 123.68)
# Distances are compared at this many digits, so equal vectors tie and go by id.
DIGITS = 9
# A worker's bound of bytes holds this many blocks; bits for the place of a vector in its block.
_BLOCKS_HELD, _PLACE_BITS = 16, 20
_MOST_ROWS = 1 << 13


def _resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize with pixel centres at half positions."""

    def places(size: int, wanted: int):
        at = np.clip((np.arange(wanted) + 0.5) * size / wanted - 0.5, 0, size - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, size - 1), at - low

    y0, y1, fy = places(image.shape[0], height)
    x0, x1, fx = places(image.shape[1], width)
    fx = fx[None, :, None]
    rows = image.astype(np.float64)
    top = rows[y0][:, x0] * (1 - fx) + rows[y0][:, x1] * fx
    bottom = rows[y1][:, x0] * (1 - fx) + rows[y1][:, x1] * fx
    fy = fy[:, None, None]
    # Pixels stay whole numbers, as in the byte image.
    return np.rint(top * (1 - fy) + bottom * fy)


def prepare_images(
    images: DataFrame,
    size: tuple[int, int] = (224, 224),
    means: Sequence[float] = CHANNEL_MEANS,
    key: str = "path",
) -> DataFrame:
    """Resize, subtract channel means, put channels first: key, pixels (flat array<float>)."""
    height, width = size
    shift = np.asarray(means, dtype=np.float32)

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pixels = []
            for row in batch.itertuples(index=False):
                image = np.frombuffer(row.data, dtype=np.uint8)
                image = image.reshape(row.height, row.width, row.channels)
                if row.channels == 1:
                    image = np.repeat(image, 3, axis=2)
                image = _resize(image[:, :, :3], height, width).astype(np.float32) - shift
                pixels.append(image.transpose(2, 0, 1).reshape(-1))
            yield pd.DataFrame({key: batch[key], "pixels": pixels})

    # Files that could not be decoded have no size; failed_images lists them.
    columns = images.filter("height > 0").select(key, "height", "width", "channels", "data")
    kind = T.StructType(
        [images.schema[key], T.StructField("pixels", T.ArrayType(T.FloatType()))]
    )
    return columns.mapInPandas(prepare, kind)


def image_features(
    prepared: DataFrame,
    make_predict: Callable[[int], Callable[[np.ndarray], np.ndarray]],
    layer: int,
    shape: Sequence[int],
    key: str = "path",
    batch_size: int = 32,
) -> DataFrame:
    """Feature vector of every image from one layer of a model: key, layer, embedding.

    `make_predict(layer)` loads the model on the worker and returns its batch function.
    """
    features = predict_batch_udf(
        lambda: make_predict(layer),
        return_type=T.ArrayType(T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=[list(shape)],
    )
    return prepared.select(
        key, F.lit(layer).alias("layer"), features("pixels").alias("embedding")
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    with np.errstate(divide="ignore", invalid="ignore"):
        return matrix / length[:, None]


def _whole(vector: str) -> Column:
    """Whether a vector is there with all its components."""
    return F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull()) & (F.size(vector) > 0)


def _packed(base: DataFrame, by: list[str], key: str, vector: str, block_bytes: int) -> DataFrame:
    """Vectors in blocks of bounded size, as they are read: by, dim, block, keys (sorted), vectors (flat)."""
    kind = base.schema[key].dataType
    out = T.StructType(
        [base.schema[c] for c in by]
        + [T.StructField("dim", T.IntegerType()), T.StructField("block", T.LongType()),
           T.StructField("keys", T.ArrayType(kind)), T.StructField("vectors", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            table = batch.take(pc.sort_indices(batch.column(0)))
            names = list(zip(pc.list_value_length(table.column(1)).to_pylist(), *[c.to_pylist() for c in table.columns[2:]]))
            places: dict[tuple, list[int]] = {}
            for row, name in enumerate(names):
                places.setdefault(name, []).append(row)
            for (dim, *values), rows in places.items():
                size = max(1, min(block_bytes // (8 * dim), _MOST_ROWS))
                for at in range(0, len(rows), size):
                    part = table.take(pa.array(rows[at : at + size]))
                    flat = part.column(1).flatten().cast(pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(2 + n).slice(0, 1) for n in range(len(by))], pa.array([dim], pa.int32()),
                         pa.array([number], pa.int64()),
                         pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                         pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
                        names=out.names,
                    )
                    number += 1

    return base.select(key, vector, *by).mapInArrow(run, out)


def similar(
    base: DataFrame,
    queries: DataFrame,
    top: int = 10,
    key: str = "vec_id",
    query_key: str = "query_id",
    vector: str = "embedding",
    by: Sequence[str] = (),
) -> DataFrame:
    """Nearest base vectors of every query with equal values of `by`: by, query_key, key, distance, rank.

    Blocks of queries meet blocks of vectors of the same length. The base is packed into blocks
    where it is read; the queries' blocks are sent to all of them, by broadcast if their counted
    size allows, else by a join that spreads the base. Each pair of blocks keeps `top` rows per
    query. Vectors that are null, empty or have a null component take no part, nor does a query
    without a vector of its length; `unmatched` lists those. A vector without direction comes last.
    """
    by = list(by)
    bound = limit(base.sparkSession, VECTOR_BYTES)
    wanted = queries.filter(_whole(vector)).select(
        *by, F.size(vector).alias("dim"), F.col(query_key).alias("k"), F.col(vector).cast("array<double>").alias("v")
    )
    size = wanted.agg(F.sum(8 * F.col("dim").cast("bigint"))).first()[0] or 0
    # Blocks are drawn by hash; half the bound leaves room for uneven ones.
    groups = max(1, -(-2 * size * _BLOCKS_HELD // bound))
    listed = F.collect_list(F.struct("k", "v"))
    asked = wanted.groupBy(*by, "dim", F.pmod(F.xxhash64("k", "v"), F.lit(groups)).alias("_group")).agg(listed.alias("_q"))
    asked = materialize(asked.select(
        *by, "dim", F.col("_q.k").alias("asking"), F.flatten("_q.v").alias("asked")))
    given = base.filter(_whole(vector))
    blocks = _packed(given, by, key, vector, bound // _BLOCKS_HELD)
    on = [*by, "dim"]
    if fits_broadcast(asked):
        pairs = blocks.join(F.broadcast(asked), on)
    else:
        rows = given.groupBy(*by, F.size(vector).alias("dim")).agg(F.count(F.lit(1)).alias("n"))
        per_part = F.greatest(F.floor(F.lit(bound) / (8 * F.col("dim"))), F.lit(1))
        heavy = materialize(rows.select(*on, F.ceil(F.col("n") / per_part).cast("int").alias("_parts")).filter("_parts > 1"))
        pairs = skew_join(blocks, asked, on, salt_on=["block"], heavy=heavy)
    found = _nearest(pairs, by, top, key, query_key)
    return top_within(found, [*by, query_key], [F.col("distance").asc(), F.col(key).asc()], top)


def _nearest(pairs: DataFrame, by: list[str], top: int, key: str, query_key: str) -> DataFrame:
    """The best rows of every query of each pair of blocks."""
    schema = pairs.schema
    out = T.StructType(
        [schema[c] for c in by]
        + [T.StructField(query_key, schema["asking"].dataType.elementType),
           T.StructField(key, schema["keys"].dataType.elementType), T.StructField("distance", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, flat, names, wanted = (batch.column(len(by) + i)[row].values for i in range(4))
                want = wanted.to_numpy(zero_copy_only=False).reshape(len(names), -1)
                have = flat.to_numpy(zero_copy_only=False).reshape(len(keys), -1)
                distance = np.round(1.0 - _unit(want) @ _unit(have).T, DIGITS) + 0.0
                # Whole numbers of distance and place; keys are sorted, so equal distances go by
                # key. A zero vector has no direction; its distance is not a number and comes last.
                code = np.where(np.isnan(distance), 4.0, distance) * 10.0**DIGITS
                code = (np.rint(code).astype(np.int64) << _PLACE_BITS) | np.arange(len(keys))
                n = min(top, len(keys))
                best = np.partition(code, n - 1, axis=1)[:, :n] & ((1 << _PLACE_BITS) - 1)
                whose = np.repeat(np.arange(len(names)), n)
                at = best.ravel()
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(pa.array(np.full(len(at), row))) for i in range(len(by))],
                     names.take(pa.array(whose)), keys.take(pa.array(at)), pa.array(distance[whose, at], pa.float64())],
                    names=out.names,
                )

    return pairs.select(*by, "keys", "vectors", "asking", "asked").mapInArrow(run, out)


def unmatched(
    base: DataFrame,
    queries: DataFrame,
    query_key: str = "query_id",
    vector: str = "embedding",
    by: Sequence[str] = (),
) -> DataFrame:
    """Queries that `similar` gives no row for: by, query_key, reason (`no vector` or `length`)."""
    on = [*by, "dim"]
    lengths = materialize(base.filter(_whole(vector)).select(*by, F.size(vector).alias("dim")).distinct())
    whole = F.coalesce(_whole(vector), F.lit(False))
    dim = F.when(whole, F.size(vector)).alias("dim")
    known = lookup_join(queries.select(*by, query_key, dim), lengths.withColumn("_known", F.lit(True)), on, "left")
    reason = F.when(F.col("dim").isNull(), "no vector").otherwise("length")
    return known.filter("_known is null").select(*by, query_key, reason.alias("reason"))


def similar_by_layer(
    base: DataFrame, queries: DataFrame, layers: Sequence[int], top: int = 10, **names: str
) -> DataFrame:
    """The same queries against the feature tables of several layers, in one pass: adds `layer`."""
    wanted = F.col("layer").isin(list(layers))
    return similar(base.filter(wanted), queries.filter(wanted), top, by=["layer"], **names)
