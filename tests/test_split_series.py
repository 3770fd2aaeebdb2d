"""Series operators on one key split over many blocks: equal to plain pandas and numpy, whatever the block size."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textprice.operators import ordering
from textprice.operators import timeseries as ts


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(11)
    n = 403
    x = rng.normal(size=n)
    y = np.cumsum(0.3 * x + rng.normal(size=n))
    rows = [("hot", i, float(y[i]), float(x[i])) for i in range(n)] + [("cold", i, float(i % 3), 1.0) for i in range(5)]
    rng.shuffle(rows)
    return spark.createDataFrame([(str(k), int(i), float(a), float(b)) for k, i, a, b in rows], "k string, dt int, v double, x double").repartition(7).cache()


@pytest.fixture(scope="module")
def hot(series):
    return series.where("k = 'hot'").orderBy("dt").toPandas()


BLOCKS = [25, 60, 1000]


@pytest.mark.parametrize("block", BLOCKS)
def test_rolling_and_lag(series, hot, block):
    got = ordering.rolling_stats(series, "v", "k", "dt", 12, block).where("k = 'hot'").orderBy("dt").toPandas()
    assert list(got.columns) == ["k", "dt", "v", "x", "roll_mean", "roll_std"]
    np.testing.assert_allclose(got["roll_mean"].astype(float), hot["v"].rolling(12).mean(), rtol=1e-9)
    np.testing.assert_allclose(got["roll_std"].astype(float), hot["v"].rolling(12).std(), rtol=1e-9)
    got = ordering.difference(series, "v", "k", "dt", 3, block).where("k = 'hot'").orderBy("dt").toPandas()
    np.testing.assert_allclose(got["v_diff"].astype(float), hot["v"].diff(3), rtol=1e-9)


@pytest.mark.parametrize("block", BLOCKS)
def test_acf(series, hot, block):
    got = {r.lag: r.acf for r in ts.acf(series, "v", "k", 20, "dt", block).where("k = 'hot'").collect()}
    d = hot["v"].to_numpy() - hot["v"].mean()
    assert len(got) == 21
    for k, a in got.items():
        assert abs(a - (d[k:] * d[:len(d) - k]).sum() / (d * d).sum()) < 1e-12
    assert {r.lag for r in ts.acf(series, "v", "k", 20).where("k = 'cold'").collect()} == set(range(5))


def test_halo_is_not_longer_than_a_block(series):
    with pytest.raises(ValueError):
        ordering.halo_blocks(series, "k", "dt", 30, 20)


def test_blocks_are_many_groups_and_no_window_is_by_key_alone(series):
    rows = ordering.halo_blocks(series, "k", "dt", 4, 25)
    n = rows.groupBy("k", "_block").agg(F.count(F.lit(1)).alias("n"), F.count_if("_halo").alias("h")).where("k = 'hot'").collect()
    assert len(n) == 17 and max(r.n for r in n) == 29 and sorted(r.h for r in n)[:2] == [0, 4]
    plan = ordering.rolling_stats(series, "v", "k", "dt", 5, 25)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and ("avg(v" in line or "count(v" in line or "stddev" in line)]
    assert windows and all("_block" in line for line in windows)


def design(hot, p):
    y, x = hot["v"].to_numpy(), hot["x"].to_numpy()
    dy = np.diff(y)
    at = np.arange(p + 1, len(y))  # position in the series
    A = np.column_stack([np.ones(len(at)), *[dy[at - 1 - i] for i in range(1, p + 1)], x[at]])
    return at, A, dy[at - 1]


@pytest.mark.parametrize("block", BLOCKS)
@pytest.mark.parametrize("p", [0, 2])
def test_walk_forward_is_a_refit_at_every_origin(series, hot, block, p):
    got = ts.walk_forward_arx(series, "v", "k", ["x"], 100, p, "dt", block).where("k = 'hot'").orderBy("dt").toPandas()
    at, A, b = design(hot, p)
    want = {int(t): hot["v"][t - 1] + A[j] @ np.linalg.lstsq(A[:j], b[:j], rcond=None)[0] for j, t in enumerate(at) if t >= 100}
    assert got["dt"].tolist() == sorted(want)
    np.testing.assert_allclose(got["yhat"], [want[t] for t in got["dt"]], rtol=1e-7, atol=1e-7)
    one = ts.walk_forward_1lag(series, "v", "k", 100, "dt", block).where("k = 'hot'").orderBy("dt").toPandas()
    v = hot["v"].to_numpy()
    for t, yhat in zip(one["dt"], one["yhat"], strict=True):
        slope, icpt = np.polyfit(v[:t - 1], v[1:t], 1)
        assert abs(icpt + slope * v[t - 1] - yhat) < 1e-6


def test_least_squares_passes_over_dependent_columns():
    rng = np.random.default_rng(1)
    X = np.column_stack((np.ones(50), rng.normal(size=(50, 2)) * [1, 1e5]))
    y = X @ [3, 2, 1e-5] + rng.normal(size=50)
    full = np.column_stack((X, 2 * X[:, 1], np.full(50, 7.0)))
    beta = ts.least_squares((full.T @ full)[None], (full.T @ y)[None])[0]
    np.testing.assert_allclose(beta[:3], np.linalg.lstsq(X, y, rcond=None)[0], rtol=1e-7)
    assert not beta[3:].any()
    assert not ts.least_squares(np.zeros((2, 3, 3)), np.zeros((2, 3))).any()


@pytest.mark.parametrize("block", BLOCKS)
def test_running_metrics(series, hot, block):
    pred = series.withColumn("yhat", F.col("v") + F.col("x"))
    got = ts.running_metrics(pred, "v", "k", "dt", block).where("k = 'hot'").orderBy("dt").toPandas()
    e2, v = hot["x"] ** 2, hot["v"]
    np.testing.assert_allclose(got["run_rmse"], np.sqrt(e2.expanding().mean()), rtol=1e-9)
    sst = v.expanding().var(ddof=0) * np.arange(1, len(v) + 1)
    np.testing.assert_allclose(got["run_r2"][5:].astype(float), (1 - e2.cumsum() / sst)[5:], rtol=1e-6)


def test_order_search_is_the_best_direct_fit(series, hot):
    for block in BLOCKS:
        got = {r.k: r for r in ts.order_search(series, "v", "k", ["x"], 4, "dt", block).collect()}
        want = []
        for p in range(5):
            _, A, b = design(hot, p)
            A, b = A[4 - p:], b[4 - p:]
            sse = ((b - A @ np.linalg.lstsq(A, b, rcond=None)[0]) ** 2).sum()
            want.append(len(b) * np.log(sse / len(b)) + 2 * A.shape[1])
        assert got["hot"].p == int(np.argmin(want)) and abs(got["hot"].aic - min(want)) < 1e-6
        assert got["cold"].aic is None and got["cold"].nobs == 0


def test_null_exogenous_values_and_empty_series(spark, series):
    some = series.withColumn("x", F.when(F.col("dt") % 50 != 7, F.col("x")))
    got = ts.walk_forward_arx(some, "v", "k", ["x"], 100, 1).where("k = 'hot'").toPandas()
    assert len(got) and got["yhat"].notna().all() and not (got["dt"] % 50 == 7).any()
    assert ts.order_search(some, "v", "k", ["x"], 2).where("k = 'hot'").first().nobs == 400 - 8
    empty = series.limit(0)
    for df in (ts.acf(empty, "v", "k", 3), ts.order_search(empty, "v", "k", ["x"], 1), ts.walk_forward_arx(empty, "v", "k", ["x"], 3),
               ts.walk_forward_1lag(empty, "v", "k", 3), ordering.rolling_stats(empty, "v", "k"), ordering.chrono_split(empty, 3, "k")):
        assert df.count() == 0


def test_learned_lexicon(spark):
    from textprice.operators.textops import learn_lexicon
    bars = spark.createDataFrame([("s", d, float([1, 2, 1, 2, 1, 1][d])) for d in range(6)], "symbol string, dt int, close double")
    posts = spark.createDataFrame([("s", d, "good day words" if d % 2 == 0 else "bad day words") for d in range(5) for _ in range(40)]
                                  + [("s", 5, "never counted"), ("t", 0, "no bars"), ("s", 0, None)], "symbol string, dt int, tweet string")
    got = {r.word: r for r in learn_lexicon(posts, bars, prior=50.0).collect()}
    # day 4 has no direction: the close stays
    assert set(got) == {"good", "bad"}
    n, rose = {"good": 80, "bad": 80}, {"good": 80, "bad": 0}
    for w in got:
        a = 50.0 * n[w] / 480
        up, down = rose[w] + a, n[w] - rose[w] + a
        z = (np.log(up / (240 + 50 - up)) - np.log(down / (240 + 50 - down))) / np.sqrt(1 / up + 1 / down)
        assert abs(got[w].polarity - z / np.sqrt(1 + z * z)) < 1e-12
        assert abs(got[w].subjectivity - z * z / (1 + z * z)) < 1e-12
    assert got["good"].polarity > 0.5 and got["bad"].polarity < -0.5
    assert learn_lexicon(posts.limit(0), bars).count() == 0


def test_fold_errors_equal_direct_fits(spark):
    from pyspark.ml.linalg import Vectors
    from textprice.operators import models
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 4)) * [1, 100, 1e-3, 0] + [0, 1000, 0, 3]  # one column is constant
    y = X[:, 0] * 2 + X[:, 1] * 0.1 + rng.normal(size=300) + 500
    fold = rng.integers(0, 5, 300)
    rows = [(int(f), Vectors.dense(x), float(t)) for f, x, t in zip(fold, X, y, strict=True)]
    df = spark.createDataFrame([*rows, (None, Vectors.dense(X[0]), 1.0), (2, Vectors.dense(X[0]), None)], ["fold", "features", "close"])
    got = {r.fold: r for r in models.linear_cross_validation(df).collect()}
    A = np.column_stack((np.ones(300), X))
    for f in range(5):
        out = fold == f
        beta = np.linalg.lstsq(A[~out], y[~out], rcond=None)[0]
        assert got[f].n == out.sum()
        assert abs(got[f].rmse / np.sqrt(((y[out] - A[out] @ beta) ** 2).mean()) - 1) < 1e-6
    assert models.linear_cross_validation(df.where("fold = 1")).first().rmse is None
    assert models.linear_cross_validation(df.limit(0)).count() == 0


def test_share_of_groups_has_no_window(spark):
    from textprice.operators import stats
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    got = stats.group_share(df, "s")
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.s, r.n, r.pct) for r in got.collect()} == {("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)}


def test_sketches_of_days_and_micro_batches(spark):
    from textprice.operators import sketches
    rng = np.random.default_rng(3)
    v = rng.lognormal(size=60000)
    pdf = pd.DataFrame({"symbol": "s", "dt": pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 30, len(v)), "D"), "v": v})
    df = spark.createDataFrame(pdf).withColumn("dt", F.to_date("dt"))
    table = sketches.day_sketches(df, ["v"])
    told = sketches.describe_range(table, ["v"], "2024-01-03", "2024-01-20")
    days = df.where("dt BETWEEN '2024-01-03' AND '2024-01-20'")
    own = np.sort(days.toPandas()["v"])
    r = told.first()
    assert r.n == len(own) and r.lo == own[0] and r.hi == own[-1] and abs(r["mean"] - own.mean()) < 1e-9
    for p, q in ((0.25, r.p25), (0.5, r.p50), (0.75, r.p75)):
        assert abs(np.searchsorted(own, q) / len(own) - p) < sketches.RANK_ERROR
    assert sketches.rank_errors(days, told, ["v"], ["symbol"]).first().rank_error < sketches.RANK_ERROR
    h = {x.bin: x for x in sketches.histogram_sketches(sketches.merge_sketches(table, ["v"]), ["v"]).collect()}
    exact, edges = np.histogram(v, 10)
    for i in range(10):
        assert abs(h[i].n - exact[i]) < 2 * sketches.RANK_ERROR * len(v) and abs(h[i].bin_start - edges[i]) < 1e-9
    empty = sketches.describe_sketches(sketches.sketch_columns(df.withColumn("v", F.lit(None).cast("double")), ["v"]), ["v"]).first()
    assert empty.n == 0 and empty.p50 is None
    one = sketches.histogram_sketches(sketches.sketch_columns(df.withColumn("v", F.lit(2.0)), ["v"]), ["v"]).where("bin = 0").first()
    assert one.n == len(v)
