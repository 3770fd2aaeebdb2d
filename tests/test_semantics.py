
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textprice.functions.labels import sentiment_label
from textprice.operators import features as ft
from textprice.operators import joins, ordering, stats, textops
from textprice.operators.timeseries import adf_autolag, durbin_levinson
from textprice.plans.preprocessing import cleaner_stage


def test_cleaner_order_and_ascii_word_class(spark):
    rows = [(1, "Été :smile_face: see http://x.y/z @bob #tag 5% $abc!"), (2, "#only @tags"),
            (3, "   "), (4, ""), (5, None), (6, "Don't stop")]
    df = spark.createDataFrame(rows, "doc_id long, tweet string")
    out = {r.doc_id: r.clean_tweet for r in textops.clean_text(df).collect()}
    assert out[1] == "t  see    5% $abc"
    assert 2 in out and out[2].strip() == ""      # whitespace survives; only '' is dropped
    assert out[3] == "   "
    assert 4 not in out and 5 not in out          # '' and null dropped
    assert out[6] == "dont stop"                  # apostrophe removed before stop words


def test_cleaner_stage_equals_expression(spark):
    rows = [(i, t) for i, t in enumerate(["A :x_y: b", "www.q.com Hi!", "#a", "ok $5 10%", ""])]
    df = spark.createDataFrame(rows, "doc_id long, tweet string")
    a = {r.doc_id: r.clean_tweet for r in textops.clean_text(df).collect()}
    b = {r.doc_id: r.clean_tweet for r in cleaner_stage().transform(df).collect()}
    assert a == b


def test_tokenizer_edge_cases(spark):
    df = spark.createDataFrame([(1, ""), (2, "   "), (3, "a  b "), (4, "dont the x")],
                               "doc_id long, clean_tweet string")
    t = {r.doc_id: r.tokens_all for r in textops.tokenize(df).collect()}
    assert t[1] == [""] and t[2] == [] and t[3] == ["a", "", "b"]
    s = {r.doc_id: r.tokens for r in textops.remove_stop_words(textops.tokenize(df)).collect()}
    assert s[4] == ["dont", "x"]


def test_sentiment_label_nan_null_and_band(spark):
    rows = [(1, 100.02, 100.0), (2, 99.98, 100.0), (3, 100.005, 100.0), (4, float("nan"), 100.0),
            (5, None, 100.0), (6, 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "id long, p double, c double")
    got = {r.id: r.s for r in df.select("id", sentiment_label(F.col("p"), F.col("c")).alias("s")).collect()}
    assert got == {1: "Positive", 2: "Negative", 3: "Neutral", 4: "Neutral", 5: None, 6: "Neutral"}


def test_minmax_constant_column_is_half_and_not_clipped(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0)], "doc_id long, a double, b double")
    s = {r.doc_id: (r.mm_a, r.mm_b) for r in ft.minmax_scale_columns(df, ["a", "b"]).collect()}
    assert s == {1: (0.0, 0.5), 2: (1.0, 0.5)}


def test_attach_predictions_last_wins_and_unmatched_kept(spark):
    posts = spark.createDataFrame([(1, "2024-01-01", "x", 10.0), (2, "2024-01-01", "x", 10.0),
                                   (3, "2024-01-02", "y", 10.0)],
                                  "doc_id long, dt string, tweet string, close double")
    preds = spark.createDataFrame([(1, "2024-01-01", "x", 9.0, 10.0), (7, "2024-01-01", "x", 11.0, 10.0)],
                                  "seq long, dt string, tweet string, prediction double, close double")
    got = {r.doc_id: (r.prediction, r.sentiment) for r in joins.attach_predictions(posts, preds).collect()}
    assert got == {1: (11.0, "Positive"), 2: (11.0, "Positive"), 3: (None, None)}


def test_row_index_with_hot_key_matches_pandas(spark):
    rng = np.random.default_rng(7)
    n = 3000
    sym = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    pdf = pd.DataFrame({"doc_id": np.arange(n), "symbol": sym, "dt": rng.integers(0, 20, n)})
    df = spark.createDataFrame(pdf)
    got = ordering.row_index(df, ["dt", "doc_id"], ["symbol"]).toPandas().set_index("doc_id")["row_idx"]
    exp = pdf.sort_values(["symbol", "dt", "doc_id"]).groupby("symbol").cumcount() + 1
    assert (got.sort_index() == exp.sort_index()).all()
    glob = ordering.row_index(df, ["dt", "doc_id"]).toPandas().set_index("doc_id")["row_idx"]
    exp_g = pd.Series(np.arange(1, n + 1), index=pdf.sort_values(["dt", "doc_id"]).doc_id)
    assert (glob.sort_index() == exp_g.sort_index()).all()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=500), np.full(400, 2.5)])   # heavy tie
    df = spark.createDataFrame(pd.DataFrame({"v": vals, "w": vals * 3}))
    q = {(r.col_name, r.p): r.q for r in stats.exact_quantiles(df, ["v", "w"]).collect()}
    for p in (0.25, 0.5, 0.75):
        assert math.isclose(q[("v", p)], np.percentile(vals, p * 100), rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(q[("w", p)], np.percentile(vals * 3, p * 100), rel_tol=1e-12, abs_tol=1e-12)


def test_pages_concatenate_without_gap_or_repeat(spark):
    from textprice.sources import paging
    rows = [(i, f"2024-01-{1 + i % 9:02d}", "s") for i in range(257)]
    df = spark.createDataFrame(rows, "doc_id long, dt string, symbol string").withColumn("dt", F.to_date("dt"))
    seen, after = [], None
    while True:
        pg = paging.page(df, "s", 50, after)
        ids = [r.doc_id for r in pg.orderBy(F.col("dt").desc(), F.col("doc_id").desc()).collect()]
        if not ids:
            break
        seen += ids
        after = paging.next_cursor(pg)
    exp = [r.doc_id for r in df.orderBy(F.col("dt").desc(), F.col("doc_id").desc()).collect()]
    assert seen == exp


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = ft.hash_split(df.repartition(3)).toPandas().set_index("doc_id")["part"].sort_index()
    b = ft.hash_split(df.repartition(7)).toPandas().set_index("doc_id")["part"].sort_index()
    assert (a == b).all() and len(a) == 2000
    assert 0.15 < (a == "test").mean() < 0.25


def test_durbin_levinson_closed_form():
    r = [1.0, 0.6, 0.3]
    out = durbin_levinson(r)
    assert math.isclose(out[1], 0.6) and math.isclose(out[2], (0.3 - 0.36) / (1 - 0.36))


def test_unit_root_statistic_separates_walk_from_noise():
    rng = np.random.default_rng(1)
    walk = np.cumsum(rng.normal(size=400))
    noise = rng.normal(size=400)
    assert adf_autolag(walk)["stat"] > adf_autolag(walk)["crit_5"]
    assert adf_autolag(noise)["stat"] < adf_autolag(noise)["crit_1"]


def test_running_metrics_last_row_is_overall(spark):
    from textprice.operators.timeseries import running_metrics
    rng = np.random.default_rng(5)
    y = rng.normal(size=50)
    yhat = y + rng.normal(scale=0.3, size=50)
    pdf = pd.DataFrame({"k": "a", "dt": np.arange(50), "v": y, "yhat": yhat})
    out = running_metrics(spark.createDataFrame(pdf), "v", "k").orderBy("dt").toPandas()
    rmse = math.sqrt(np.mean((y - yhat) ** 2))
    r2 = 1 - np.sum((y - yhat) ** 2) / np.sum((y - y.mean()) ** 2)
    assert math.isclose(out.run_rmse.iloc[-1], rmse, rel_tol=1e-9)
    assert math.isclose(out.run_r2.iloc[-1], r2, rel_tol=1e-9)


def test_dup_count(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (1, "a")], "x long, y string")
    from textprice.operators.quality import dup_count
    row = dup_count(df).first()
    assert (row.n_rows, row.n_distinct, row.n_duplicates) == (4, 2, 2)


@pytest.mark.parametrize("bins", [3, 10])
def test_histogram_counts_every_value_once(spark, bins):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    h = stats.histogram(df, ["v"], bins).toPandas()
    assert h.n.sum() == 101 and h.bin.max() == bins - 1


def test_range_partitioning_splits_a_hot_key(spark):
    """A key with 40 % of the rows is spread over several range partitions (the ordering
    columns after the key act as tie-breakers), so no task gets the whole hot key."""
    n = 20000
    df = spark.range(n).select(F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("symbol"), F.col("id").alias("doc_id"))
    parts = df.repartitionByRange(8, "symbol", "doc_id").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in parts.collect()]
    assert max(sizes) < 0.25 * n


def test_incremental_replay_resumes_from_stored_cursor(spark):
    from textprice.session import scratch_path
    from textprice.sources import paging
    rows = [(i, f"2024-01-{1 + i % 9:02d}", "s") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, dt string, symbol string").withColumn("dt", F.to_date("dt"))
    folder = scratch_path(spark, "replay-test")
    got = [paging.append_next_page(df, "s", 50, folder) for _ in range(4)]
    assert got == [0, 1, 2, None]
    back = spark.read.schema("doc_id long, dt string, page_no int").json(f"{folder}/pages")
    exp = [r.doc_id for r in df.orderBy(F.col("dt").desc(), F.col("doc_id").desc()).collect()]
    seen = [r.doc_id for r in back.orderBy("page_no", F.col("dt").desc(), F.col("doc_id").desc()).collect()]
    assert seen == exp


def edge_series(spark):
    """A constant, a 2-day and a 3-day key, a key with one value, beside a normal one."""
    rng = np.random.default_rng(2)
    rows = [("constant", d, 5.0, 1.0) for d in range(30)] + [("two", d, float(d), 1.0) for d in range(2)]
    rows += [("three", d, float(d * d), 1.0) for d in range(3)] + [("one", 0, 1.0, 1.0)]
    rows += [("normal", d, float(v), float(d % 4)) for d, v in enumerate(rng.normal(size=60))]
    return spark.createDataFrame(rows, "k string, dt int, v double, x double")


def test_series_operators_survive_constant_and_short_keys(spark):
    from textprice.operators import timeseries as ts
    s = edge_series(spark)
    a = ts.acf(s, "v", "k", 5)
    acf = {(r.k, r.lag): r.acf for r in a.collect()}
    assert acf["constant", 0] is None and acf["normal", 0] == 1.0
    p = {(r.k, r.lag): r.pacf for r in ts.pacf(a, "k").collect()}
    assert abs(p["normal", 1] - acf["normal", 1]) < 1e-12
    zero = {r.k: r.stat for r in ts.unit_root_lag0(s, "v", "k").collect()}
    assert zero["normal"] < -3 and zero["constant"] is None and zero["two"] is None and zero["three"] is None
    auto = {r.k: r for r in ts.unit_root_aic(s, "v", "k").collect()}
    assert auto["normal"].stat < -2 and all(auto[k].stat is None for k in ("constant", "two", "three", "one"))
    order = {r.k: r.aic for r in ts.order_search(s, "v", "k", ["x"], max_p=2).collect()}
    assert order["normal"] is not None and order["two"] is None and order["one"] is None
    w = ts.walk_forward_1lag(s, "v", "k", 20)
    assert {r.k for r in w.collect()} == {"constant", "normal"}
    assert {r.k for r in ts.walk_forward_arx(s, "v", "k", ["x"], 20).collect()} == {"constant", "normal"}
    m = ts.running_metrics(w, "v", "k").collect()
    assert all(r.run_r2 is None for r in m if r.k == "constant") and all(r.run_r2 is not None for r in m if r.k == "normal" and r.dt > 21)


def test_order_search_compares_orders_on_one_sample(spark):
    from textprice.operators import timeseries as ts
    s = edge_series(spark).filter("k = 'normal'")
    assert [r.nobs for r in ts.order_search(s, "v", "k", ["x"], max_p=4).collect()] == [60 - 1 - 4]


def test_row_numbers_and_counts_keep_null_keys(spark):
    df = spark.createDataFrame([(1, None, 3), (2, None, 1), (3, "a", 2), (4, "a", None)], "doc_id long, symbol string, dt int")
    got = {r.doc_id: r.row_idx for r in ordering.row_index(df, ["dt", "doc_id"], ["symbol"]).collect()}
    assert got == {2: 1, 1: 2, 4: 1, 3: 2}
    down = {r.doc_id: r.r for r in ordering.row_index(df, ["dt", "doc_id"], ["symbol"], "r", start=0, descending=True).collect()}
    assert down == {1: 0, 2: 1, 3: 0, 4: 1}
    counts = {r.doc_id: r.n_day for r in stats.count_per_day(df, ("symbol",)).collect()}
    assert counts == {1: 2, 2: 2, 3: 2, 4: 2}


def test_numbering_has_no_python(spark):
    df = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("dt"))
    plan = ordering.row_index(df, ["dt", "doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan


def test_replay_of_laid_out_pages_ends_after_the_last(spark):
    from textprice.session import scratch_path
    from textprice.sources import paging
    rows = [(i, f"2024-01-{1 + i % 9:02d}", "s" if i % 4 else "t") for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, dt string, symbol string").withColumn("dt", F.to_date("dt"))
    layout, folder = scratch_path(spark, "layout"), scratch_path(spark, "replayed")
    paging.lay_out_pages(df, 50, layout)
    assert [paging.replay_next_page(spark, layout, "s", folder) for _ in range(4)] == [0, 1, 2, None]
    back = spark.read.json(f"{folder}/pages")
    assert back.count() == 120 and back.select("doc_id").distinct().count() == 120


def test_correlation_with_a_column_that_does_not_vary(spark):
    """NaN as in DuckDB, not an error in ANSI mode; rows that lack one of two are left out."""
    import math

    from textprice.operators import stats
    rows = [("a", 1.0, 5.0, 2.0), ("a", 2.0, 5.0, 1.0), ("a", 3.0, 5.0, None), ("b", 1.0, 2.0, 3.0)]
    got = {(r.symbol, r.col_a, r.col_b): r.r for r in stats.corr_matrix(
        spark.createDataFrame(rows, "symbol string, x double, y double, z double"), ["x", "y", "z"]).collect()}
    assert math.isnan(got["a", "x", "y"]) and math.isnan(got["a", "y", "z"])
    assert abs(got["a", "x", "z"] + 1) < 1e-12 and got["b", "x", "y"] is None
