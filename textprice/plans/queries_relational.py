"""Registered relational queries: quality (B), aggregation (D), ordering (E), joins (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, ordering, quality, sketches, stats
from ..schemas import LIVE_COLUMNS
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.tables import table
from .catalog import register
from .oracle import fingerprint_sql


def _s(c: str = "dt"):
    return F.col(c).cast("string").alias(c)


POST_OUT = ["doc_id", "dt", "tweet", "symbol", "open", "high", "low", "close", "adj_close", "volume"]


def _posts_out(df):
    return df.select(*[(_s(c) if c == "dt" else F.col(c)) for c in POST_OUT if c in df.columns])


POSTS_SQL = ("SELECT doc_id, CAST(dt AS VARCHAR) AS dt, tweet, symbol, open, high, low, close, "
             "adj_close, volume FROM {src}")


@register("posts_with_bars", POSTS_SQL.format(src="posts"))
def posts_with_bars(spark, sf):
    return _posts_out(fx.posts(spark, sf))


@register("drop_then_dropna", """
SELECT doc_id, tweet, open, high, low, close, volume FROM posts_dirty
WHERE doc_id IS NOT NULL AND tweet IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL
  AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL""")
def drop_then_dropna(spark, sf):
    return quality.drop_then_dropna(fx.posts_dirty(spark, sf))


@register("dropna_all", POSTS_SQL.format(src="posts_dirty") + """
WHERE doc_id IS NOT NULL AND dt IS NOT NULL AND tweet IS NOT NULL AND symbol IS NOT NULL
  AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
  AND adj_close IS NOT NULL AND volume IS NOT NULL""")
def dropna_all(spark, sf):
    return _posts_out(quality.dropna_all(fx.posts_dirty(spark, sf)))


@register("column_select", "SELECT doc_id, tweet, close FROM posts")
def column_select(spark, sf):
    return quality.column_selector(["doc_id", "tweet", "close"]).transform(fx.posts(spark, sf))


@register("align_columns", """
SELECT CAST(dt AS VARCHAR) AS dt, tweet, low, high, open, close, volume,
       CAST(NULL AS DOUBLE) AS prediction, CAST(NULL AS VARCHAR) AS sentiment FROM posts""")
def align_columns(spark, sf):
    return quality.align_columns(fx.posts(spark, sf), LIVE_COLUMNS).withColumn("dt", F.col("dt").cast("string"))


@register("filter_symbol", POSTS_SQL.format(src="posts") + " WHERE symbol = 'purchase'")
def filter_symbol(spark, sf):
    return _posts_out(quality.filter_symbol(fx.posts(spark, sf), "purchase"))


@register("dedup_rows", "SELECT DISTINCT * FROM (" + POSTS_SQL.format(src="posts_dirty") + ")")
def dedup_rows(spark, sf):
    return quality.dedup_rows(_posts_out(fx.posts_dirty(spark, sf)))


@register("dup_count", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM posts_dirty
      GROUP BY doc_id, dt, tweet, symbol, open, high, low, close, adj_close, volume)""")
def dup_count(spark, sf):
    return quality.dup_count(fx.posts_dirty(spark, sf))


@register("parse_date", """
SELECT doc_id, date_text, CAST(TRY_CAST(date_text AS DATE) AS VARCHAR) AS date_value
FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'bad-' || CAST(dt AS VARCHAR)
                          ELSE CAST(dt AS VARCHAR) END AS date_text FROM posts)""")
def parse_date(spark, sf):
    p = fx.posts(spark, sf)
    txt = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("bad-"), F.col("dt").cast("string"))) \
        .otherwise(F.col("dt").cast("string"))
    out = quality.parse_date(p.select("doc_id", txt.alias("date_text")), "date_text")
    return out.select("doc_id", "date_text", F.col("date_value").cast("string").alias("date_value"))


def _quality_sql():
    cols = ["doc_id", "dt", "tweet", "symbol", "open", "high", "low", "close", "adj_close", "volume"]
    dbl = {"open", "high", "low", "close", "adj_close", "volume"}
    parts = []
    for c in cols:
        nan = f"CAST(count_if(isnan({c})) AS BIGINT)" if c in dbl else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{c}' AS col_name, count(*) AS n_rows, CAST(10 AS BIGINT) AS n_cols, "
                     f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, {nan} AS n_nan FROM posts_dirty")
    return "\nUNION ALL ".join(parts)


@register("quality_report", _quality_sql())
def quality_report(spark, sf):
    return quality.quality_report(fx.posts_dirty(spark, sf))


@register("row_index", """
SELECT doc_id, CAST(row_number() OVER (ORDER BY dt, doc_id) AS BIGINT) AS row_idx FROM posts""")
def row_index(spark, sf):
    return ordering.row_index(fx.posts(spark, sf).select("doc_id", "dt"), ["dt", "doc_id"]).select("doc_id", "row_idx")


@register("row_index_symbol", """
SELECT doc_id, symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY dt, doc_id) AS BIGINT) AS row_idx
FROM posts""")
def row_index_symbol(spark, sf):
    p = fx.posts(spark, sf).select("doc_id", "symbol", "dt")
    return ordering.row_index(p, ["dt", "doc_id"], ["symbol"]).select("doc_id", "symbol", "row_idx")


@register("head_n", "SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol FROM posts ORDER BY dt, doc_id LIMIT 5")
def head_n(spark, sf):
    return ordering.head_n(fx.posts(spark, sf), 5).select("doc_id", _s(), "symbol")


@register("schema_profile", """
SELECT * FROM (VALUES (0, 'doc_id', 'bigint'), (1, 'dt', 'date'), (2, 'tweet', 'string'),
  (3, 'symbol', 'string'), (4, 'open', 'double'), (5, 'high', 'double'), (6, 'low', 'double'),
  (7, 'close', 'double'), (8, 'adj_close', 'double'), (9, 'volume', 'double'))
  AS t(position, col_name, data_type)
JOIN (SELECT unnest(['doc_id','dt','tweet','symbol','open','high','low','close','adj_close','volume']) AS col_name,
             unnest([count(doc_id), count(dt), count(tweet), count(symbol), count(open), count(high),
                     count(low), count(close), count(adj_close), count(volume)]) AS non_null
      FROM posts_dirty) USING (col_name)""")
def schema_profile(spark, sf):
    return quality.schema_profile(fx.posts_dirty(spark, sf))


# ---- D: aggregation ------------------------------------------------------------------

@register("distinct_symbols", "SELECT count(DISTINCT symbol) AS n_distinct FROM posts")
def distinct_symbols(spark, sf):
    return stats.distinct_count(fx.posts(spark, sf), "symbol")


@register("distinct_symbols_approx", "SELECT count(DISTINCT symbol) AS n_distinct FROM posts")
def distinct_symbols_approx(spark, sf):
    """D2 with HyperLogLog++ (2 % relative error; exact at this small cardinality)."""
    return stats.distinct_count(fx.posts(spark, sf), "symbol", approx_rsd=0.02)


@register("symbol_list", "SELECT DISTINCT symbol FROM posts")
def symbol_list(spark, sf):
    return stats.distinct_values(fx.posts(spark, sf), "symbol")


@register("symbol_share", """
SELECT symbol, n, round(CAST(100 AS DOUBLE) * n / sum(n) OVER (), 6) AS pct
FROM (SELECT symbol, count(*) AS n FROM posts GROUP BY symbol)""")
def symbol_share(spark, sf):
    return stats.group_share(fx.posts(spark, sf), "symbol")


@register("posts_per_day", """
SELECT doc_id, symbol, CAST(dt AS VARCHAR) AS dt, count(*) OVER (PARTITION BY symbol, dt) AS n_day FROM posts""")
def posts_per_day(spark, sf):
    p = fx.posts(spark, sf).select("doc_id", "symbol", "dt")
    return stats.count_per_day(p).select("doc_id", "symbol", _s(), "n_day")


ROLLUP_SQL = """
SELECT symbol, CAST(dt AS VARCHAR) AS dt, count(*) AS n_posts,
       arg_min(open, doc_id) AS open, arg_min(high, doc_id) AS high, arg_min(low, doc_id) AS low,
       arg_min(close, doc_id) AS close, arg_min(adj_close, doc_id) AS adj_close,
       arg_min(volume, doc_id) AS volume,
       CAST(sum(length({t})) + count({t}) - 1 AS BIGINT) AS text_chars,
       CAST(sum({fp}) AS BIGINT) AS text_fp
FROM {src} GROUP BY symbol, dt"""


@register("daily_rollup", ROLLUP_SQL.format(t="tweet", fp=fingerprint_sql("tweet"), src="posts"))
def daily_rollup(spark, sf):
    return stats.daily_rollup(fx.posts(spark, sf)).withColumn("dt", F.col("dt").cast("string"))


def _daily_cols():
    return ["open", "high", "low", "adj_close", "volume", "close", "n_posts"]


def _corr_sql():
    from itertools import combinations
    cols = _daily_cols()
    parts = [f"SELECT symbol, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM daily GROUP BY symbol"
             for a, b in combinations(cols, 2)]
    return (", daily AS (SELECT symbol, dt, count(*) AS n_posts, arg_min(open, doc_id) AS open, "
            "arg_min(high, doc_id) AS high, arg_min(low, doc_id) AS low, arg_min(close, doc_id) AS close, "
            "arg_min(adj_close, doc_id) AS adj_close, arg_min(volume, doc_id) AS volume FROM posts GROUP BY symbol, dt)\n"
            + "\nUNION ALL ".join(parts))


@register("corr_matrix", _corr_sql())
def corr_matrix(spark, sf):
    daily = stats.daily_rollup(fx.posts(spark, sf))
    out = stats.corr_matrix(daily, _daily_cols())
    return out.withColumn("r", F.round("r", 6))


def _corr_wide_sql():
    from itertools import combinations
    cols = _daily_cols()
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM daily"
             for a, b in combinations(cols, 2)]
    return (", daily AS (SELECT symbol, dt, CAST(count(*) AS DOUBLE) AS n_posts, arg_min(open, doc_id) AS open, "
            "arg_min(high, doc_id) AS high, arg_min(low, doc_id) AS low, arg_min(close, doc_id) AS close, "
            "arg_min(adj_close, doc_id) AS adj_close, arg_min(volume, doc_id) AS volume FROM posts GROUP BY symbol, dt)\n"
            + "\nUNION ALL ".join(parts))


@register("corr_matrix_wide", _corr_wide_sql())
def corr_matrix_wide(spark, sf):
    """D8 over all symbols' daily rows at once via ml.stat.Correlation (many-column path)."""
    daily = stats.daily_rollup(fx.posts(spark, sf)).withColumn("n_posts", F.col("n_posts").cast("double"))
    out = stats.corr_matrix_wide(daily, _daily_cols())
    return out.withColumn("r", F.round("r", 6))


DESCRIBE_COLS = ["open", "high", "low", "close", "volume"]


def _describe_sql():
    parts = [f"""SELECT '{c}' AS col_name, count({c}) AS cnt, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, min({c}) AS min_v, max({c}) AS max_v,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75 FROM posts_dirty_nn""" for c in DESCRIBE_COLS]
    return (", posts_dirty_nn AS (SELECT * FROM posts_dirty WHERE close IS NOT NULL AND adj_close IS NOT NULL)\n"
            + "\nUNION ALL ".join(parts))


@register("describe_numeric", _describe_sql())
def describe_numeric(spark, sf):
    p = fx.posts_dirty(spark, sf).na.drop("any", subset=["close", "adj_close"])
    d = stats.describe_numeric(p, DESCRIBE_COLS)
    return d.select("col_name", "cnt", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min_v", "max_v",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")])


_RANGE = ("2024-01-05", "2024-01-20")


@register("describe_day_range", f"""
SELECT event_type AS symbol, 'value' AS metric, count(value) AS n, min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean, true AS quartiles_close
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}' GROUP BY event_type""")
def describe_day_range(spark, sf):
    """D9 of a range of days, from a written table of one sketch per (symbol, day): counts, extremes and means are exact,
    quartiles within the sketch's rank error of the exact ones."""
    events = table(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("dt"), "value")
    path = scratch_path(spark, "day-sketches")
    sketches.day_sketches(events, ["value"]).write.parquet(path)
    told = sketches.describe_range(spark.read.parquet(path), ["value"], *_RANGE)
    off = sketches.rank_errors(events.where(F.col("dt").between(*[F.lit(d).cast("date") for d in _RANGE])), told, ["value"], ["symbol"])
    return told.join(off, ["symbol", "metric"]).select("symbol", "metric", "n", "lo", "hi", F.round("mean", 6).alias("mean"),
                                                       (F.col("rank_error") <= sketches.RANK_ERROR).alias("quartiles_close"))


HIST_COLS = ["low", "high", "open", "close", "volume"]


def _hist_sql():
    stack = " UNION ALL ".join(f"SELECT '{c}' AS metric, {c} AS v FROM posts" for c in HIST_COLS)
    return f""", long AS ({stack}),
rng AS (SELECT metric, min(v) AS lo, max(v) AS hi FROM long GROUP BY metric),
b AS (SELECT l.metric, r.lo, r.hi,
        CASE WHEN r.hi = r.lo THEN 0 ELSE least(CAST(floor((l.v - r.lo) / (r.hi - r.lo) * 10) AS INTEGER), 9) END AS bin
      FROM long l JOIN rng r USING (metric) WHERE l.v IS NOT NULL)
SELECT metric, bin, count(*) AS n, round(min(lo) + bin * (min(hi) - min(lo)) / 10, 6) AS bin_start
FROM b GROUP BY metric, bin"""


@register("metric_histogram", _hist_sql())
def metric_histogram(spark, sf):
    h = stats.histogram(fx.posts(spark, sf), HIST_COLS, 10)
    return h.withColumn("bin_start", F.round("bin_start", 6))


@register("metric_stats", """
, per AS (SELECT symbol, sqrt(avg((close - open) * (close - open))) AS rmse FROM posts GROUP BY symbol)
SELECT round(avg(rmse), 6) AS avg_metric, round(stddev_pop(rmse), 6) AS std_metric,
       round(max(rmse), 6) AS max_metric, round(min(rmse), 6) AS min_metric FROM per""")
def metric_stats(spark, sf):
    p = fx.posts(spark, sf)
    per = p.groupBy("symbol").agg(F.sqrt(F.avg((F.col("close") - F.col("open")) ** 2)).alias("rmse"))
    out = stats.metric_stats(per, "rmse")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


ATTACH_SQL = """
, last AS (SELECT dt, tweet, arg_max(prediction, seq) AS prediction, arg_max(close, seq) AS pred_close
           FROM predictions GROUP BY dt, tweet),
attached AS (
  SELECT p.*, l.prediction,
         CASE WHEN l.prediction IS NULL THEN NULL
              WHEN isnan(l.prediction) OR isnan(l.pred_close) THEN 'Neutral'
              WHEN l.prediction > l.pred_close * 1.0001 THEN 'Positive'
              WHEN l.prediction < l.pred_close * 0.9999 THEN 'Negative' ELSE 'Neutral' END AS sentiment
  FROM posts p LEFT JOIN last l ON p.dt = l.dt AND p.tweet = l.tweet)
"""


def _attached(spark, sf):
    return joins.attach_predictions(fx.posts(spark, sf), fx.predictions(spark, sf))


@register("attach_predictions", ATTACH_SQL + "SELECT doc_id, prediction, sentiment FROM attached")
def attach_predictions(spark, sf):
    return _attached(spark, sf).select("doc_id", "prediction", "sentiment")


@register("sentiment_counts", ATTACH_SQL + "SELECT sentiment, count(*) AS n FROM attached WHERE sentiment IS NOT NULL GROUP BY sentiment")
def sentiment_counts(spark, sf):
    return stats.sentiment_counts(_attached(spark, sf))


@register("live_kpis", ATTACH_SQL + """
SELECT count(*) AS n_posts, count(prediction) AS n_scored,
       round(coalesce(avg(prediction), 0.0), 6) AS mean_prediction FROM attached""")
def live_kpis(spark, sf):
    k = stats.live_kpis(_attached(spark, sf))
    return k.withColumn("mean_prediction", F.round("mean_prediction", 6))


@register("sentiment_label", """
SELECT seq, CASE WHEN prediction IS NULL THEN NULL
              WHEN isnan(prediction) OR isnan(close) THEN 'Neutral'
              WHEN prediction > close * 1.0001 THEN 'Positive'
              WHEN prediction < close * 0.9999 THEN 'Negative' ELSE 'Neutral' END AS sentiment
FROM predictions""")
def sentiment_label(spark, sf):
    from ..functions.labels import sentiment_label as label
    p = fx.predictions(spark, sf)
    return p.select("seq", label(F.col("prediction"), F.col("close")).alias("sentiment"))


@register("append_posts", """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol, close, CAST(NULL AS DOUBLE) AS prediction, CAST(NULL AS BIGINT) AS seq FROM posts
UNION ALL
SELECT CAST(NULL AS BIGINT), CAST(dt AS VARCHAR), CAST(NULL AS VARCHAR), close, prediction, seq FROM predictions""")
def append_posts(spark, sf):
    a = fx.posts(spark, sf).select("doc_id", _s(), "symbol", "close")
    b = fx.predictions(spark, sf).select(_s(), "close", "prediction", "seq")
    return joins.append_rows(a, b).select("doc_id", "dt", "symbol", "close", "prediction", "seq")


# ---- E: ordering and windows ------------------------------------------------------------

@register("sort_date", "SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol FROM posts ORDER BY dt, doc_id")
def sort_date(spark, sf):
    return ordering.sort_by_date(fx.posts(spark, sf)).select("doc_id", _s(), "symbol")


@register("latest_posts", "SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol FROM posts ORDER BY dt DESC, doc_id DESC LIMIT 10")
def latest_posts(spark, sf):
    return ordering.latest_posts(fx.posts(spark, sf), 10).select("doc_id", _s(), "symbol")


@register("tail_posts", "SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol FROM posts ORDER BY dt, doc_id LIMIT 10")
def tail_posts(spark, sf):
    return ordering.tail_posts(fx.posts(spark, sf), 10).select("doc_id", _s(), "symbol")


@register("latest_per_symbol", """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt DESC, doc_id DESC) AS rn FROM posts) WHERE rn <= 3""")
def latest_per_symbol(spark, sf):
    return ordering.latest_posts(fx.posts(spark, sf), 3, per="symbol").select("doc_id", _s(), "symbol")


@register("rolling_stats", """
SELECT symbol, CAST(dt AS VARCHAR) AS dt, close,
  round(CASE WHEN count(close) OVER w = 12 THEN avg(close) OVER w END, 6) AS roll_mean,
  round(CASE WHEN count(close) OVER w = 12 THEN stddev_samp(close) OVER w END, 6) AS roll_std
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def rolling_stats(spark, sf):
    b = fx.bars(spark, sf).select("symbol", "dt", "close")
    r = ordering.rolling_stats(b, "close", window=12)
    return r.select("symbol", _s(), "close", F.round("roll_mean", 6).alias("roll_mean"),
                    F.round("roll_std", 6).alias("roll_std"))


@register("difference_lag", """
SELECT symbol, CAST(dt AS VARCHAR) AS dt, close,
       lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS close_lag1,
       round(close - lag(close) OVER (PARTITION BY symbol ORDER BY dt), 6) AS close_diff
FROM bars""")
def difference_lag(spark, sf):
    b = fx.bars(spark, sf).select("symbol", "dt", "close")
    d = ordering.difference(b, "close")
    return d.select("symbol", _s(), "close", "close_lag1", F.round("close_diff", 6).alias("close_diff"))


@register("chrono_split", """
SELECT k, CAST(dt AS VARCHAR) AS dt, pos, CASE WHEN pos <= 166 THEN 'train' ELSE 'test' END AS part
FROM (SELECT k, dt, CAST(row_number() OVER (PARTITION BY k ORDER BY dt) AS INTEGER) AS pos FROM series_long)""")
def chrono_split(spark, sf):
    s = fx.series_long(spark, sf)
    return ordering.chrono_split(s, 166, key="k").select("k", _s(), "pos", "part")
