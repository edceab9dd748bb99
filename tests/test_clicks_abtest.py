import numpy as np
import pytest

from irspark.operators import abtest, clicks
from irspark.sources import sessions as S


def sessions(spark, rows):
    return spark.createDataFrame(rows, "query string, urls array<string>, clicks array<int>")


def test_dbn_counts(spark):
    rows = [("q", ["a", "b", "c"], [3, 1]), ("q", ["b", "a"], [1, 1]), ("q", ["a"], []), ("r", ["a"], [1])]
    got = {(r.query, r.url): (r.a_d, r.a_n, r.s_n) for r in clicks.dbn_counts(sessions(spark, rows)).collect()}
    assert got == {("q", "a"): (1, 1, 1), ("q", "b"): (2, 2, 1), ("q", "c"): (1, 1, 0), ("r", "a"): (1, 1, 1)}
    rel = {(r.query, r.url): r.rel for r in clicks.dbn(sessions(spark, rows)).collect()}
    assert rel[("q", "b")] == pytest.approx(3 / 4 * 2 / 4)
    assert [r.url for r in clicks.top_for_query(clicks.dbn(sessions(spark, rows)), "q").collect()] == ["a", "b", "c"]


def test_session_log(spark, tmp_path):
    (tmp_path / "log").write_text("0\t0\tq w\t213\t3\ta\tb\tc\t2\t1\n1\t0\tz\t1\t1\ta\n")
    got = {r.query: (r.region, r.urls, r.clicks) for r in S.read_sessions(spark, str(tmp_path / "log")).collect()}
    assert got == {"q w": ("213", ["a", "b", "c"], [2, 1]), "z": ("1", ["a"], [])}


def test_click_matrix_keeps_file_order(spark, tmp_path):
    cells = np.random.default_rng(0).integers(0, 2, (50, 4))
    np.savetxt(tmp_path / "m.txt", cells)
    rows = S.read_click_matrix(spark, str(tmp_path / "m.txt"), "a").orderBy("row_idx").collect()
    assert [r.row_idx for r in rows] == list(range(50))
    assert np.array_equal(np.array([r.clicks for r in rows]), cells)


def matrix(spark, p_a, p_b, n=4000):
    rng = np.random.default_rng(1)
    rows = [(s, i, [int(c) for c in rng.random(3) < p]) for s, p in (("a", p_a), ("b", p_b)) for i in range(n)]
    return spark.createDataFrame(rows, "split string, row_idx long, clicks array<int>")


def test_t_test_against_formula(spark):
    m = matrix(spark, 0.3, 0.32)
    series = abtest.ctr(m, 100)
    pdf = series.toPandas()
    x, y = (pdf[pdf.split == s].value.to_numpy() for s in "ab")
    pooled = ((len(x) - 1) * x.var(ddof=1) + (len(y) - 1) * y.var(ddof=1)) / (len(x) + len(y) - 2)
    t = (x.mean() - y.mean()) / np.sqrt(pooled) * np.sqrt(len(x) * len(y) / (len(x) + len(y)))
    row = abtest.t_test(series, "a", "b").first()
    assert row.t_value == pytest.approx(t)
    assert row.t_critical == pytest.approx(1.990847, abs=1e-5)
    assert row.rejected == int(abs(t) > row.t_critical)


def test_alpha_is_used(spark):
    series = abtest.ctr(matrix(spark, 0.3, 0.3), 100)
    assert abtest.t_test(series, "a", "b", 0.5).first().t_critical < abtest.t_test(series, "a", "b").first().t_critical


def test_bootstrap_tells_splits_apart(spark):
    args = dict(count_iteration=40, size_sample=2000, size_group=100)
    same = abtest.bootstrap(matrix(spark, 0.3, 0.3), "a", "b", **args).first()
    differ = abtest.bootstrap(matrix(spark, 0.2, 0.4), "a", "b", abtest.first_click, **args).first()
    assert same.iterations == 40 and same.share < 0.5
    assert differ.share == 1.0


def test_draws_are_uniform_and_repeatable():
    def drawn(seed, n):
        return abtest.draw_index(seed, "a", 1, abtest._mixed(np.arange(20000)), n)

    few = np.bincount(drawn("s", 10), minlength=10)
    assert len(few) == 10 and few.min() > 1800
    many = drawn("s", 3_000_000_000)
    assert np.array_equal(many, drawn("s", 3_000_000_000)) and not np.array_equal(many, drawn("t", 3_000_000_000))
    assert np.bincount(many // 300_000_000, minlength=10).min() > 1800
    # Neither low digits nor neighbours depend on each other.
    assert np.bincount(many % 7, minlength=7).min() > 2600
    assert abs(np.corrcoef(many[:-1], many[1:])[0, 1]) < 0.03


def scrambled(number):
    y = number % 2147483647
    for shift, factor, plus in ((15, 48271, 11), (13, 1103515245, 17), (16, 668265261, 23)):
        y = ((y ^ (y >> shift)) * factor + plus) % 2147483647
    return y


@pytest.mark.parametrize("hot", [False, True])
def test_resamples_against_brute_force(spark, request, hot):
    if hot:
        request.getfixturevalue("tiny_limits")
    rng = np.random.default_rng(5)
    cells = {"a": rng.random(1700).tolist(), "b": rng.random(900).tolist()}
    cells["a"][3] = None
    rows = [(s, i, m) for s, ms in cells.items() for i, m in enumerate(ms)]
    values = spark.createDataFrame(rows, "split string, row_idx bigint, m double")
    sizes = {s: len(m) for s, m in cells.items()}
    got = abtest.resampled_means(values, sizes, 7, 1050, 100, "k")
    assert "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()
    got = {(r.iteration, r.split, r.block): r.value for r in got.collect()}
    want = {}
    for split, ms in cells.items():
        upper, lower = abtest._seeds("k", split)
        for i in range(7):
            for t in range(1050):
                e, n = scrambled(t), len(ms)
                x, y = scrambled(e ^ scrambled(i + upper)), scrambled(e ^ scrambled(i + lower))
                want.setdefault((i, split, t // 100), []).append(ms[(x * n + y * n // 2147483647) // 2147483647])
    assert set(got) == set(want)
    for key, drawn in want.items():
        assert got[key] == pytest.approx(np.mean([m for m in drawn if m is not None]))


def test_bootstrap_without_sessions(spark):
    one = matrix(spark, 0.3, 0.3, 50).filter("split = 'a'")
    row = abtest.bootstrap(one, "a", "b", count_iteration=3, size_sample=40, size_group=10).first()
    assert (row.iterations, row.rejected) == (3, 0)
    assert abtest.bootstrap(one.limit(0), "a", "b", count_iteration=3, size_sample=40, size_group=10).first().iterations == 0


def test_head(spark):
    series = abtest.clicks_at_1(matrix(spark, 0.3, 0.3), 100)
    assert abtest.head(series, 3).count() == 6
