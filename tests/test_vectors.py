import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from irspark.operators import vectors
from irspark.sources.images import read_images


def png(pixels: np.ndarray) -> bytes:
    h, w, _ = pixels.shape

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images_from_folder(spark, tmp_path):
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (4, 6, 3), dtype=np.uint8)
    (tmp_path / "a.png").write_bytes(png(image))
    rows = read_images(spark, str(tmp_path))
    assert rows.count() == 1
    prepared = vectors.prepare_images(rows, (4, 6)).first()
    got = np.array(prepared.pixels).reshape(3, 4, 6)
    bgr = image[:, :, ::-1].astype(float) - np.array(vectors.CHANNEL_MEANS)
    assert np.allclose(got, bgr.transpose(2, 0, 1), atol=1e-3)
    assert len(vectors.prepare_images(rows).first().pixels) == 3 * 224 * 224


def test_resize_halves_and_doubles():
    image = np.arange(16, dtype=np.uint8).reshape(4, 4, 1) * 10
    half = vectors._resize(image, 2, 2)[:, :, 0]
    assert half.tolist() == [[25, 45], [105, 125]]
    flat = vectors._resize(np.full((3, 3, 3), 7, np.uint8), 10, 5)
    assert (flat == 7).all() and flat.shape == (10, 5, 3)


def base(spark, n=200):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(n, 8)).round(2)
    m[n // 2 :] = m[: n - n // 2]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), m


@pytest.mark.parametrize("limit, sent", [(1 << 20, 1 << 23), (300, 1 << 23), (3000, 10)])
def test_similar_is_exact(spark, limit, sent):
    df, m = base(spark)
    spark.conf.set("spark.irspark.vectorBytes", str(limit))
    spark.conf.set("spark.irspark.broadcastBytes", str(sent))
    try:
        queries = df.filter(F.col("vec_id") < 20).withColumnRenamed("vec_id", "query_id")
        got = vectors.similar(df.repartition(3), queries, 5).orderBy("query_id", "rank").collect()
    finally:
        spark.conf.unset("spark.irspark.vectorBytes")
        spark.conf.unset("spark.irspark.broadcastBytes")
    unit = m.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    distance = np.round(1 - unit @ unit.T, 9) + 0.0
    for q in range(20):
        want = sorted(range(len(m)), key=lambda i: (distance[q, i], i))[:5]
        assert [r.vec_id for r in got if r.query_id == q] == want


def test_layers(spark):
    df, _ = base(spark)
    both = df.withColumn("layer", F.lit(8)).unionByName(df.withColumn("layer", F.lit(31)))
    queries = both.filter("vec_id = 3").withColumnRenamed("vec_id", "query_id")
    got = vectors.similar_by_layer(both, queries, [8, 31], 2)
    assert {(r.layer, r.vec_id) for r in got.collect()} == {(8, 3), (8, 103), (31, 3), (31, 103)}


def test_features_by_layer(spark):
    rows = [(i, [float(i)] * 12) for i in range(5)]
    df = spark.createDataFrame(rows, "path long, pixels array<float>")

    def model(layer):
        def run(batch):
            return batch.reshape(len(batch), -1)[:, : layer + 1] * 2

        return run

    got = vectors.image_features(df, model, 1, (3, 2, 2)).orderBy("path").collect()
    assert [list(r.embedding) for r in got] == [[2.0 * i, 2.0 * i] for i in range(5)]


def test_odd_lengths_take_nothing_from_others(spark):
    rows = [(i, [1.0, float(i)]) for i in range(6)] + [(50, [1.0, 2.0, 3.0]), (51, []), (52, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = [("a", [1.0, 3.0]), ("long", [1.0] * 5), ("three", [2.0, 4.0, 6.0]), ("null", None), ("hole", [1.0, None]), ("none", [])]
    queries = spark.createDataFrame(asked, "query_id string, embedding array<double>")
    got = vectors.similar(df, queries, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [("a", 3), ("a", 4), ("a", 5), ("three", 50)]
    odd = vectors.unmatched(df, queries).collect()
    assert sorted(map(tuple, odd)) == [("hole", "no vector"), ("long", "length"), ("none", "no vector"), ("null", "no vector")]
    assert vectors.similar(df.limit(0), queries, 3).count() == vectors.similar(df, queries.limit(0), 3).count() == 0


def test_no_base_row_is_shuffled_before_the_cut(spark):
    df, _ = base(spark)
    queries = df.filter("vec_id < 3").withColumnRenamed("vec_id", "query_id")
    plan = vectors.similar(df, queries, 2)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("WindowGroupLimit")[-1]
    assert "BroadcastHashJoin" in below and "hashpartitioning" not in below
