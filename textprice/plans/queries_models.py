"""Registered feature and model queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import joins, models, stats
from ..operators import timeseries as ts
from ..schemas import PREDICTION_MESSAGE_SCHEMA
from ..session import scratch_path, stored
from ..sources import fixtures as fx
from ..streaming import ingest, kpis, score
from . import preprocessing as pp
from .catalog import register
from .daily import daily_features as build_daily
from .oracle import clean_sql, order_search_sql, regression_sql, walk_forward_sql
from .queries_relational import ATTACH_SQL
from .queries_stream import finite
from .queries_text import _TFIDF_CTE

MM_COLS = ["open", "high", "low", "volume"]


@register("minmax_scale", ", st AS (SELECT " + ", ".join(
    f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in MM_COLS) + " FROM posts)\nSELECT doc_id, " + ", ".join(
    f"round(CASE WHEN hi_{c} = lo_{c} THEN 0.5 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END, 9) AS mm_{c}"
    for c in MM_COLS) + " FROM posts, st")
def minmax_scale(spark, sf):
    s = ft.minmax_scale_columns(fx.posts(spark, sf).select("doc_id", *MM_COLS), MM_COLS)
    return s.select("doc_id", *[F.round(f"mm_{c}", 9).alias(f"mm_{c}") for c in MM_COLS])


Z_COLS = ["open", "close", "volume"]


@register("standard_scale", "SELECT doc_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 9) AS z_{c}"
    for c in Z_COLS) + " FROM posts")
def standard_scale(spark, sf):
    s = ft.standard_scale(fx.posts(spark, sf).select("doc_id", *Z_COLS), Z_COLS)
    return s.select("doc_id", *[F.round(f"z_{c}", 9).alias(f"z_{c}") for c in Z_COLS])


@register("hash_split", """
SELECT doc_id, CASE WHEN substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 4) < '3333' THEN 'test' ELSE 'train' END AS part
FROM posts""")
def hash_split(spark, sf):
    return ft.hash_split(fx.posts(spark, sf).select("doc_id"))


@register("linreg_fit", """
SELECT round(regr_slope(close, open), 6) AS slope, round(regr_intercept(close, open), 6) AS intercept,
       count(*) AS n FROM posts""")
def linreg_fit(spark, sf):
    p = fx.posts(spark, sf).select("open", "close")
    vec = ft.assemble(["open"], "features").transform(p)
    m = models.linear_regression("features", "close").fit(vec)
    # The fitted coefficients are a model summary; they are returned with the row count the
    # fit saw, as one row derived from the table.
    return p.agg(F.count(F.lit(1)).alias("n")).select(
        F.round(F.lit(float(m.coefficients[0])), 6).alias("slope"),
        F.round(F.lit(float(m.intercept)), 6).alias("intercept"), "n")


_FOLD_SQL = "CAST(('0x' || substr(md5('7:' || CAST(doc_id AS VARCHAR)), 1, 6)) AS BIGINT) % 5"


@register("linreg_folds", f"""
, f AS (SELECT close, open, {_FOLD_SQL} AS fold FROM posts),
s AS (SELECT fold, (SELECT regr_slope(close, open) FROM f b WHERE b.fold <> a.fold) AS slope,
             (SELECT regr_intercept(close, open) FROM f b WHERE b.fold <> a.fold) AS icpt FROM (SELECT DISTINCT fold FROM f) a)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(sqrt(avg((close - icpt - slope * open) * (close - icpt - slope * open))), 6) AS rmse
FROM f JOIN s USING (fold) GROUP BY fold""")
def linreg_folds(spark, sf):
    """G12 for least squares: every fold's error from one pass of sums."""
    fold = F.conv(F.substring(F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string"))), 1, 6), 16, 10).cast("long") % 5
    p = fx.posts(spark, sf).select("open", "close", fold.cast("int").alias("fold"))
    cv = models.linear_cross_validation(ft.assemble(["open"], "features").transform(p))
    return cv.withColumn("rmse", F.round("rmse", 6))


@register("regression_metrics", ATTACH_SQL + """
SELECT count(*) AS n, round(sqrt(avg((close - prediction) * (close - prediction))), 6) AS rmse,
       round(1 - sum((close - prediction) * (close - prediction)) / (var_pop(close) * count(*)), 6) AS r2
FROM attached WHERE prediction IS NOT NULL""")
def regression_metrics(spark, sf):
    a = joins.attach_predictions(fx.posts(spark, sf), fx.predictions(spark, sf)) \
        .filter(F.col("prediction").isNotNull())
    m = models.regression_metrics(a, "close", "prediction")
    return m.select("n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


def _daily_sql(digits="round({}, 6)"):
    mm = ["volume", "n_posts", "max_tfidf", "mean_tfidf", "sum_tfidf", "close"]
    zc = ["volume", "open", "n_posts", "max_tfidf", "mean_tfidf", "sum_tfidf", "close"]
    other = ["high", "low", "polarity", "subjectivity"]
    mm_sel = ", ".join(
        f"CASE WHEN max({c}) OVER s = min({c}) OVER s THEN {c} - min({c}) OVER s "
        f"ELSE ({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s) END AS {c}" for c in mm)
    z_sel = ", ".join(
        digits.format(f"({c} - avg({c}) OVER s) / CASE WHEN stddev_pop({c}) OVER s = 0 THEN 1 ELSE stddev_pop({c}) OVER s END") + f" AS {c}"
        for c in zc)
    return _TFIDF_CTE + f""",
roll AS (SELECT symbol, dt, CAST(count(*) AS DOUBLE) AS n_posts, arg_min(open, doc_id) AS open,
                arg_min(high, doc_id) AS high, arg_min(low, doc_id) AS low, arg_min(close, doc_id) AS close,
                arg_min(volume, doc_id) AS volume FROM posts GROUP BY symbol, dt),
lw AS (SELECT symbol, dt, unnest(regexp_extract_all(lower(tweet), '[a-z]{{3,}}')) AS word FROM posts),
sc AS (SELECT symbol, dt, avg(polarity) AS pol, avg(subjectivity) AS subj FROM lw JOIN lexicon USING (word) GROUP BY symbol, dt),
tfs AS (SELECT d.symbol, d.dt,
          coalesce(CASE WHEN nrm > 0 THEN mx / nrm END, 0.0) AS max_tfidf,
          coalesce(CASE WHEN nrm > 0 THEN sx / nrm / n_vocab END, 0.0) AS mean_tfidf,
          coalesce(CASE WHEN nrm > 0 THEN sx / nrm END, 0.0) AS sum_tfidf
        FROM days d LEFT JOIN per USING (symbol, dt) LEFT JOIN voc USING (symbol)),
base AS (SELECT r.symbol, r.dt, r.open, r.high, r.low, r.close, r.volume, r.n_posts,
                coalesce(sc.pol, 0.0) AS polarity, coalesce(sc.subj, 0.0) AS subjectivity,
                t.max_tfidf, t.mean_tfidf, t.sum_tfidf
         FROM roll r LEFT JOIN sc USING (symbol, dt) LEFT JOIN tfs t USING (symbol, dt)),
mmd AS (SELECT symbol, dt, open, {", ".join(other)}, {mm_sel} FROM base WINDOW s AS (PARTITION BY symbol))
SELECT symbol, CAST(dt AS VARCHAR) AS dt, {", ".join(f"{digits.format(c)} AS {c}" for c in other)}, {z_sel}
FROM mmd WINDOW s AS (PARTITION BY symbol)"""


@register("daily_features", _daily_sql())
def daily_features(spark, sf):
    d = build_daily(fx.posts(spark, sf), fx.lexicon(spark, sf))
    return d.select("symbol", F.col("dt").cast("string").alias("dt"),
                    *[F.round(c, 6).alias(c) for c in d.columns if c not in ("symbol", "dt")])


def _base_daily_sql(select):
    """The unscaled daily features (``base`` of the daily SQL) and a final SELECT."""
    sql = _daily_sql()
    return sql[:sql.index("mmd AS (")].rstrip().rstrip(",") + "\n" + select


def _corr_parts(cols):
    from itertools import combinations
    return "\nUNION ALL ".join(f"SELECT symbol, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM base GROUP BY symbol"
                               for a, b in combinations(cols, 2))


SENTIMENT_COLS = ["close", "polarity", "subjectivity"]
TFIDF_COLS = ["close", "volume", "n_posts", "max_tfidf", "mean_tfidf", "sum_tfidf"]
EXOG = ["volume", "open", "n_posts", "max_tfidf", "mean_tfidf", "sum_tfidf"]  # of the daily forecasts of the close


def _daily_corr(spark, sf, cols):
    d = build_daily(fx.posts(spark, sf), fx.lexicon(spark, sf), scale=False)
    return stats.corr_matrix(d, cols).withColumn("r", F.round("r", 6))


@register("corr_sentiment", _base_daily_sql(_corr_parts(SENTIMENT_COLS)))
def corr_sentiment(spark, sf):
    """Close against polarity and subjectivity, unscaled daily features."""
    return _daily_corr(spark, sf, SENTIMENT_COLS)


@register("corr_tfidf", _base_daily_sql(_corr_parts(TFIDF_COLS)))
def corr_tfidf(spark, sf):
    """The TF-IDF column set of the unscaled daily features."""
    return _daily_corr(spark, sf, TFIDF_COLS)


def _scaled_daily_sql():
    """CTEs up to ``scaled``: the daily features as the forecasts take them, unrounded."""
    sql = _daily_sql("{}")
    at = sql.rindex("\nSELECT symbol")
    return sql[:at] + ",\nscaled AS (" + sql[at:] + "),\n"


@register("daily_order_search", _scaled_daily_sql() + order_search_sql("scaled", "symbol", "dt", "close", EXOG, 5))
def daily_order_search(spark, sf):
    """H4 on the daily features: lag order 0..5 by AIC with the six exogenous columns."""
    d = build_daily(fx.posts(spark, sf), fx.lexicon(spark, sf))
    o = ts.order_search(d, "close", "symbol", EXOG, max_p=5)
    return o.select("symbol", "p", F.round("aic", 3).alias("aic"), "nobs")


@register("daily_walk_forward", _scaled_daily_sql() + walk_forward_sql("scaled", "symbol", "dt", "close", EXOG, 20, 1) + """
SELECT symbol, dt, round(yhat, 5) AS yhat FROM wf_p""")
def daily_walk_forward(spark, sf):
    """H5 on the daily features: one-step forecasts of the close with the six exogenous columns."""
    d = build_daily(fx.posts(spark, sf), fx.lexicon(spark, sf))
    w = ts.walk_forward_arx(d, "close", "symbol", EXOG, 20, p=1)
    return w.select("symbol", F.col("dt").cast("string").alias("dt"), F.round("yhat", 5).alias("yhat"))


# ---- fitted pipelines ------------------------------------------------------------------------

# rows of one part of the split that the pipeline scores
_PART = """, part AS (SELECT doc_id, close, clean_tweet,
  CASE WHEN substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 4) < '3333' THEN 'test' ELSE 'train' END AS part
  FROM clean_posts WHERE clean_tweet <> '')
"""


def _split_posts(spark, sf):
    return ft.hash_split(fx.posts(spark, sf))


@register("feature_width", "SELECT 104 AS min_width, 104 AS max_width, count(*) AS n_rows FROM clean_posts WHERE clean_tweet <> ''")
def feature_width(spark, sf):
    p = _split_posts(spark, sf)
    return models.feature_width(pp.narrow(p, pp.fit_preprocessing(p), ["features"]))


@register("batch_score", _PART + "SELECT doc_id, close, true AS finite FROM part WHERE part = 'test'")
def batch_score(spark, sf):
    p = _split_posts(spark, sf)
    model = pp.fit_full_model(p.filter(F.col("part") == "train"))
    s = pp.score(p.filter(F.col("part") == "test"), model, ["doc_id", "close", "prediction"])
    return s.select("doc_id", "close", finite().alias("finite"))


NUMBERS_SQL = """, part AS (SELECT doc_id, close, open, high, low, volume,
  CASE WHEN substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 4) < '3333' THEN 'test' ELSE 'train' END AS part
  FROM clean_posts WHERE clean_tweet <> ''),
train AS (SELECT * FROM part WHERE part = 'train'),
""" + regression_sql("fit", "train", "close", MM_COLS) + """
SELECT doc_id, close, round(m_label + """ + " + ".join(f"b_{c} * ({c} - m_{c})" for c in MM_COLS) + """, 4) AS prediction
FROM part, fit"""


@register("batch_score_numbers", NUMBERS_SQL + " WHERE part = 'test'")
def batch_score_numbers(spark, sf):
    """G17 on the numbers alone, whose least squares SQL can follow: scaled, assembled, fitted and scored."""
    p = _split_posts(spark, sf)
    model = pp.fit_full_model(p.filter(F.col("part") == "train"), embedding="none")
    return pp.score(p.filter(F.col("part") == "test"), model).select("doc_id", "close", F.round("prediction", 4).alias("prediction"))


@register("stream_score_numbers", NUMBERS_SQL)
def stream_score_numbers(spark, sf):
    """I2 on the numbers alone: the saved pipeline scores the stream, values as in SQL."""
    model = pp.fit_full_model(_split_posts(spark, sf).filter(F.col("part") == "train"), embedding="none")
    model = pp.load_model(pp.save_model(model, scratch_path(spark, "numbers-model")))
    folder, out = scratch_path(spark, "numbers-in"), scratch_path(spark, "numbers-out")
    ingest.write_messages(fx.posts(spark, sf).withColumn("dt", F.col("dt").cast("string")), folder)
    score.score_messages(ingest.read_raw(spark, folder), model, out, out + "-dead", out + "-offsets")
    rows = kpis.read_committed(spark, out, PREDICTION_MESSAGE_SCHEMA)
    return rows.select("doc_id", "close", F.round("prediction", 4).alias("prediction"))


@register("score_dirty", f"""
SELECT doc_id, count(*) AS n, true AS finite FROM posts_dirty WHERE coalesce({clean_sql('tweet')}, '') <> '' GROUP BY doc_id""")
def score_dirty(spark, sf):
    """G16/G17 on dirty rows: rows without a close don't train, all rows with inputs and a text are scored."""
    p = fx.posts_dirty(spark, sf)
    s = pp.score(p, pp.fit_full_model(p), ["doc_id", "prediction"])
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.every(finite()).alias("finite"))


@register("train_from_table", _PART + """
SELECT count(*) AS n_rows, 104 AS min_width, 104 AS max_width, CAST(0 AS BIGINT) AS n_null, 104 AS n_coefficients, true AS residuals_free FROM part WHERE part = 'train'""")
def train_from_table(spark, sf):
    """G16 from the stored (features, close) table.  Least squares leaves residuals without a mean and
    without covariance with any feature: checked relative to the label's and the features' spread."""
    p = _split_posts(spark, sf).filter(F.col("part") == "train")
    path = pp.write_training_table(p, pp.fit_preprocessing(p), scratch_path(spark, "training"))
    model = pp.train_from_table(spark, path)
    t = model.transform(spark.read.parquet(path)).withColumn("e", F.col("close") - F.col("prediction"))
    a = vector_to_array("features")
    places = range(len(model.coefficients))
    moments = t.select("e", "close", a.alias("a")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.size("a")).alias("min_width"), F.max(F.size("a")).alias("max_width"),
        F.count_if(F.col("close").isNull() | F.col("a").isNull()).alias("n_null"),
        F.abs(F.avg("e")).alias("mean"), F.stddev_pop("close").alias("spread"),
        *[F.abs(F.covar_pop("e", F.col("a")[i])).alias(f"c{i}") for i in places],
        *[F.stddev_pop(F.col("a")[i]).alias(f"s{i}") for i in places])
    free = F.col("mean") <= 1e-4 * F.col("spread")
    for i in places:
        free = free & (F.col(f"c{i}") <= 1e-4 * F.col(f"s{i}") * F.col("spread") + 1e-9)
    return moments.select("n_rows", "min_width", "max_width", "n_null", F.lit(len(model.coefficients)).alias("n_coefficients"),
                          free.alias("residuals_free"))


@register("model_roundtrip", _PART + "SELECT doc_id, true AS same FROM part WHERE part = 'test'")
def model_roundtrip(spark, sf):
    p = _split_posts(spark, sf)
    model = pp.fit_full_model(p.filter(F.col("part") == "train"))
    path = pp.save_model(model, scratch_path(spark, "model"))
    test = p.filter(F.col("part") == "test")
    a = pp.score(test, model, ["doc_id", "prediction"])
    b = pp.score_saved(test, path, ["doc_id", "prediction"]).withColumnRenamed("prediction", "reloaded_prediction")
    return a.join(b, "doc_id").select("doc_id", (F.abs(F.col("prediction") - F.col("reloaded_prediction")) < 1e-9).alias("same"))


@register("model_compare", """
SELECT * FROM (VALUES ('Linear Regression', 1, true), ('Decision Tree Regression', 2, true), ('Random Forest Regression', 2, true),
                      ('Gradient Boosted Tree Regression', 2, true)) v(model, n_points, ordered)""")
def model_compare(spark, sf):
    p = _split_posts(spark, sf)
    train_raw = p.filter(F.col("part") == "train")
    prep = pp.fit_preprocessing(train_raw)  # fitted inside the split (no leakage)
    train = ft.fold_column(pp.narrow(train_raw, prep, ["doc_id", "features", "close"])).select("features", "close", "fold")
    test = pp.narrow(p.filter(F.col("part") == "test"), prep, ["features", "close"])
    # tables, which need no exchange and no rows to embed while models are compared
    with pp.rows_dropped(spark), stored(train, "compared-train") as train, stored(test, "compared-test") as test:
        c = models.compare_models(train, test)
    ordered = (F.col("min_rmse") <= F.col("avg_rmse")) & (F.col("avg_rmse") <= F.col("max_rmse")) & finite("test_r2")
    return c.select("model", "n_points", ordered.alias("ordered"))
