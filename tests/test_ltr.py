import numpy as np
import pytest
from pyspark.sql import functions as F

from irspark.operators import ltr
from irspark.sources import learning as S


def frame(spark, seed=0, n=120, levels=4, queries=3, tie=10):
    rng = np.random.default_rng(seed)
    rows = [
        (int(rng.integers(queries)), i, float(rng.integers(levels)), float(rng.integers(tie)) / 7, rng.random(3).tolist())
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "query_id long, doc_id long, label double, score double, features array<double>")


def groups(df):
    pdf = df.toPandas()
    return [(q, g.sort_values("doc_id")) for q, g in pdf.groupby("query_id")]


def brute_errors(df):
    total = 0
    for _, g in groups(df):
        p, y = g.score.to_numpy(), g.label.to_numpy()
        total += ((p[:, None] <= p[None, :]) == (y[:, None] > y[None, :])).sum()
    return total


@pytest.mark.parametrize("levels,tie", [(2, 3), (5, 1000), (100, 4), (1, 5)])
def test_pair_errors(spark, levels, tie):
    df = frame(spark, levels=levels, tie=tie)
    assert ltr.pair_errors(df).first()[0] == brute_errors(df)


def test_pair_errors_in_a_hot_query(spark, tiny_limits):
    df = frame(spark, n=300, queries=1, tie=50)
    assert ltr.pair_errors(df).first()[0] == brute_errors(df)


def brute_delta(g, k):
    y, p, ids = g.label.to_numpy(), g.score.to_numpy(), g.doc_id.to_numpy()
    order = np.lexsort((ids, -p))
    rank = np.empty(len(y), int)
    rank[order] = np.arange(1, len(y) + 1)
    gain, disc = 2**y - 1, np.log2(rank + 1)
    best = np.sort(gain)[::-1][:k]
    ideal = (best / np.log2(np.arange(len(best)) + 2)).sum()
    swap = np.abs((gain[:, None] - gain[None, :]) * (1 / disc[None, :] - 1 / disc[:, None]))
    swap *= (rank[:, None] <= k) | (rank[None, :] <= k)
    return ids, swap / ideal if ideal else swap


def test_delta_ndcg(spark):
    df = frame(spark)
    got = {(r.doc_i, r.doc_j): r.delta for r in ltr.delta_ndcg(df, 4).collect()}
    for _, g in groups(df):
        ids, want = brute_delta(g, 4)
        for a, i in enumerate(ids):
            for b, j in enumerate(ids):
                assert got.get((i, j), 0.0) == pytest.approx(want[a, b], abs=1e-12)


@pytest.mark.parametrize("k", [None, 4])
def test_gradient(spark, k):
    df = frame(spark)
    got = {r.doc_id: r["lambda"] for r in ltr.lambda_gradient(df, sigma=0.7, k_delta=k).collect()}
    for _, g in groups(df):
        y, h = g.label.to_numpy(), g.score.to_numpy()
        sign = np.sign(y[:, None] - y[None, :])
        push = sign * 0.7 / (1 + np.exp(0.7 * (h[:, None] - h[None, :]) * sign))
        if k:
            push = push * brute_delta(g, k)[1]
        for i, want in zip(g.doc_id, push.sum(axis=1)):
            assert got[i] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("levels,sigma,scale,block", [(4, 0.7, 900, 7), (40, 2.0, 300, 7), (2, 1.0, 5000, 1000), (1, 1.0, 5000, 7)])
def test_gradient_of_far_scores(spark, levels, sigma, scale, block):
    df = frame(spark, n=260, levels=levels, queries=2, tie=40).withColumn("score", (F.col("score") - 3) * scale)
    spark.conf.set("spark.irspark.pairBlock", str(block))
    try:
        rows = ltr.lambda_gradient(df, sigma=sigma).collect()
    finally:
        spark.conf.unset("spark.irspark.pairBlock")
    assert len(rows) == 260
    got = {r.doc_id: r["lambda"] for r in rows}
    for _, g in groups(df):
        y, h = g.label.to_numpy(), g.score.to_numpy()
        sign = np.sign(y[:, None] - y[None, :])
        with np.errstate(over="ignore"):
            push = sign * sigma / (1 + np.exp(sigma * (h[:, None] - h[None, :]) * sign))
        for i, want in zip(g.doc_id, push.sum(axis=1)):
            assert got[i] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_gradient_of_far_scores_in_a_hot_query(spark, tiny_limits):
    df = frame(spark, n=200, levels=6, queries=1, tie=60).withColumn("score", F.col("score") * 700)
    got = {r.doc_id: r["lambda"] for r in ltr.lambda_gradient(df).collect()}
    (_, g), = groups(df)
    y, h = g.label.to_numpy(), g.score.to_numpy()
    sign = np.sign(y[:, None] - y[None, :])
    with np.errstate(over="ignore"):
        push = sign / (1 + np.exp((h[:, None] - h[None, :]) * sign))
    assert [got[i] for i in g.doc_id] == pytest.approx(push.sum(axis=1).tolist(), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("levels,scale", [(3, 0.1), (70, 4.0), (900, 30.0)])
def test_gradient_of_crowded_scores_lists_no_pairs(spark, monkeypatch, levels, scale):
    rng = np.random.default_rng(5)
    y, h = rng.integers(levels, size=3000).astype(float), rng.normal(0, scale, 3000).round(3)
    df = spark.createDataFrame([(1, i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, h))],
                               "query_id long, doc_id long, label double, score double")
    met = []
    summed = ltr.pairwise_sum
    monkeypatch.setattr(ltr, "pairwise_sum", lambda cells, by, *a: (
        met.append(cells.groupBy(*by).count().selectExpr("sum(count * count)").first()[0] or 0), summed(cells, by, *a))[1])
    got = {r.doc_id: r["lambda"] for r in ltr.lambda_gradient(df, sigma=1.3).collect()}
    sign = np.sign(y[:, None] - y[None, :])
    push = sign * 1.3 / (1 + np.exp(1.3 * (h[:, None] - h[None, :]) * sign))
    assert [got[i] for i in range(3000)] == pytest.approx(push.sum(axis=1).tolist(), abs=1e-10)
    assert levels > 3 or sum(met) < len(set(zip(y, h))) ** 2 / 10


def test_ndcg_bounds_and_null(spark):
    df = frame(spark).unionByName(frame(spark).withColumn("label", F.lit(0.0)).withColumn("query_id", F.lit(99).cast("long")))
    got = {r.query_id: r.ndcg for r in ltr.ndcg(df, 5).collect()}
    assert got.pop(99) is None
    assert all(0 <= v <= 1 for v in got.values())
    perfect = df.withColumn("score", F.col("label"))
    assert ltr.average_ndcg(perfect, 5).first()[0] == pytest.approx(1.0)


def test_unknown_gains():
    with pytest.raises(ValueError):
        ltr.gain(None, "other")


def test_normalize_and_split(spark):
    df = spark.createDataFrame([(1, 1, 7.0), (1, 2, 3.0), (1, 3, 7.0), (2, 4, 1.0)], "query_id long, doc_id long, label double")
    assert {r.doc_id: r.label for r in ltr.normalize_labels(df).collect()} == {1: 10.0, 2: 5.0, 3: 10.0, 4: 5.0}
    parts = {r.doc_id: r.part for r in ltr.split_by_query(df, 0.5).collect()}
    assert parts == {1: "valid", 2: "valid", 3: "valid", 4: "train"}


def test_boosting_learns(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        x = rng.random(3)
        rows.append((i % 5, i, float(int(x[0] * 4)), x.tolist()))
    df = spark.createDataFrame(rows, "query_id long, doc_id long, label double, features array<double>")
    model, history = ltr.fit(df, 3, learning_rate=0.1)
    assert history[-1]["ndcg_valid"] > 0.9
    assert history[-1]["gradient_norm"] < history[0]["gradient_norm"]
    model.save(spark, str(tmp_path / "model"))
    loaded = ltr.LambdaRankModel.load(spark, str(tmp_path / "model"))
    assert loaded == model
    scored = ltr.predict(df, loaded)
    assert ltr.average_ndcg(scored, 5).first()[0] > 0.9
    # The label normaliser is an argument.
    plain, _ = ltr.fit(df, 1, learning_rate=0.1, normalize=lambda d: d, metrics=False)
    assert plain.trees[0] == model.trees[0]


def test_matrix_reader(spark, tmp_path):
    (tmp_path / "m.csv").write_text("rel,f1,f2,qid\n" + "".join(f"{i % 3},{i}.5,2,{i // 4}\n" for i in range(12)))
    rows = S.read_matrix(spark, str(tmp_path / "m.csv")).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(12))
    assert rows[5].features == [5.5, 2.0] and rows[5].query_id == 1 and rows[5].label == 2.0


def test_many_trees(spark):
    rng = np.random.default_rng(5)

    def grow(depth):
        if not depth:
            return {"value": float(rng.normal())}
        return {
            "feature": int(rng.integers(3)), "threshold": float(rng.random()),
            "left": grow(depth - 1), "right": grow(depth - 1),
        }

    def walk(tree, x):
        while "value" not in tree:
            tree = tree["left"] if x[tree["feature"]] <= tree["threshold"] else tree["right"]
        return tree["value"]

    model = ltr.LambdaRankModel(0.01, [grow(3) for _ in range(700)])
    df = frame(spark, n=30)
    for r in ltr.predict(df, model, "p").collect():
        assert r.p == pytest.approx(sum(0.01 * walk(t, r.features) for t in model.trees))


def own_tree(x, y, depth):
    """Exact tree by trying every split."""
    best, n = None, len(y)
    base = y.sum() ** 2 / n
    for f in range(x.shape[1]) if depth else ():
        values = np.unique(x[~np.isnan(x[:, f]), f])
        for low, high in zip(values, values[1:]):
            left = x[:, f] <= low
            gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum()
            if gain - base > 1e-9 and (best is None or round(gain, 6) > best[0]):
                best = (round(gain, 6), f, (low + high) / 2, left)
    if best is None:
        return {"value": y.mean()}
    _, f, threshold, left = best
    return {"feature": f, "threshold": threshold, "left": own_tree(x[left], y[left], depth - 1),
            "right": own_tree(x[~left], y[~left], depth - 1)}


def same_tree(a, b):
    if "value" in a:
        assert a["value"] == pytest.approx(b["value"])
    else:
        assert (a["feature"], a["threshold"]) == (b["feature"], pytest.approx(b["threshold"]))
        same_tree(a["left"], b["left"])
        same_tree(a["right"], b["right"])


@pytest.mark.parametrize("split", [False, True])
def test_exact_tree(spark, split, request):
    if split:
        request.getfixturevalue("tiny_limits")
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(300, 4)), 1)
    x[rng.random((300, 4)) < 0.05] = np.nan
    x[:, 3] = 7.0
    y = np.where(x[:, 1] > 0.3, 2.0, -1.0) + rng.normal(size=300) * 0.1
    rows = [([None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "features array<double>, t double").repartition(5)
    same_tree(ltr.exact_tree(df, "t", 3), own_tree(x, y, 3))


def test_exact_tree_without_splits(spark):
    df = spark.createDataFrame([([1.0, 2.0], 5.0)] * 4, "features array<double>, t double")
    assert ltr.exact_tree(df, "t", 3) == {"value": 5.0}
    two = spark.createDataFrame([([1.0, None], 1.0), ([3.0, None], 2.0)], "features array<double>, t double")
    assert ltr.exact_tree(two, "t", 3) == {"feature": 0, "threshold": 2.0, "left": {"value": 1.0}, "right": {"value": 2.0}}


def test_binned_trees_stay(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 4, i, float(i % 3), rng.random(3).tolist()) for i in range(80)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, label double, features array<double>")
    model, _ = ltr.fit(df, 1, max_bins=8, metrics=False)
    assert "feature" in model.trees[0]
