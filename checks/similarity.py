"""Nearest vectors and image features, from the embeddings."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, r6, table
from irspark.operators import vectors


# Workers get the functions of this module with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def centroids(rows: DataFrame, *by: str) -> DataFrame:
    """Mean vector per group: by, embedding."""
    cells = rows.select(*by, F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy(*by, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    in_order = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(*by).agg(F.transform(in_order, lambda c: c["x"]).alias("embedding"))


MEANS_SQL = """
base AS (SELECT vec_id, label, vec_id % 2 AS layer, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cell AS (SELECT vec_id, label, layer, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM base)"""


@check(f"""
WITH {MEANS_SQL},
m AS (SELECT label, pos, avg(x) AS x FROM cell GROUP BY 1, 2),
q AS (SELECT label AS query_id, list(x ORDER BY pos) AS v FROM m GROUP BY 1),
dist AS (
  SELECT query_id, vec_id, round(1 - list_cosine_similarity(q.v, b.v), 9) AS distance FROM q, base b
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist)
SELECT query_id, vec_id, round(distance, 6) AS distance, rank FROM r WHERE rank <= 10
""")
def similar_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Ten vectors nearest to the mean of every label."""
    base = table(spark, d, "embeddings")
    wanted = centroids(base, "label").withColumnRenamed("label", "query_id")
    return vectors.similar(base, wanted).withColumn("distance", r6("distance"))


@check(f"""
WITH {MEANS_SQL},
m AS (SELECT layer, label, pos, avg(x) AS x FROM cell GROUP BY 1, 2, 3),
q AS (SELECT layer, label AS query_id, list(x ORDER BY pos) AS v FROM m GROUP BY 1, 2),
dist AS (
  SELECT q.layer, query_id, vec_id, round(1 - list_cosine_similarity(q.v, b.v), 9) AS distance
  FROM q JOIN base b ON b.layer = q.layer
),
r AS (SELECT *, row_number() OVER (PARTITION BY layer, query_id ORDER BY distance, vec_id) AS rank FROM dist)
SELECT layer, query_id, vec_id, round(distance, 6) AS distance, rank FROM r WHERE rank <= 10
""")
def similar_by_layer(spark: SparkSession, d: str) -> DataFrame:
    """The same against two feature tables; even and odd ids stand for two layers."""
    base = table(spark, d, "embeddings").withColumn("layer", (F.col("vec_id") % 2).cast("int"))
    wanted = centroids(base, "layer", "label").withColumnRenamed("label", "query_id")
    near = vectors.similar_by_layer(base, wanted, [0, 1])
    return near.withColumn("distance", r6("distance"))


def images(spark: SparkSession, d: str) -> DataFrame:
    """8 x 8 grey images whose pixels are the vector components."""
    pixels = F.transform(
        "embedding",
        lambda x: F.lpad(F.hex(F.greatest(F.least(F.floor((x.cast("double") + 1) * 127), F.lit(255)), F.lit(0))), 2, "0"),
    )
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(1).alias("channels"),
        F.unhex(F.array_join(pixels, "")).alias("data"),
    )


@check("""
WITH p AS (
  SELECT vec_id, unnest(embedding) AS x FROM embeddings
),
m AS (
  SELECT vec_id, avg(greatest(least(floor((CAST(x AS DOUBLE) + 1) * 127), 255), 0)) AS g FROM p GROUP BY 1
)
SELECT vec_id, 0 AS layer, round(g - 103.939, 2) AS blue, round(g - 116.779, 2) AS green, round(g - 123.68, 2) AS red
FROM m
""")
def image_features(spark: SparkSession, d: str) -> DataFrame:
    """Prepared images through a model that returns channel means."""
    prepared = vectors.prepare_images(images(spark, d), (8, 8), key="vec_id")

    def model(layer: int):
        def run(batch: np.ndarray) -> np.ndarray:
            return batch.reshape(len(batch), 3, -1).mean(axis=2)

        return run

    found = vectors.image_features(prepared, model, 0, (3, 8, 8), key="vec_id")
    return found.select(
        "vec_id",
        "layer",
        *[F.round(F.get("embedding", F.lit(i)).cast("double"), 2).alias(c) for i, c in enumerate(("blue", "green", "red"))],
    )
