"""Registered time-series queries (H1-H6) on the long daily series, all keys in parallel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as ts
from ..sources import fixtures as fx
from .catalog import register
from .oracle import order_search_sql, walk_forward_sql

NLAGS = 20
TRAIN_DAYS = 166


def _series(spark, sf):
    s = fx.series_long(spark, sf)
    return s.select("k", "dt", (F.col("y") / 1e6).alias("v"))


_ACF_CTE = """
, s AS (SELECT k, dt, y / 1e6 AS v, row_number() OVER (PARTITION BY k ORDER BY dt) AS t FROM series_long),
m AS (SELECT k, avg(v) AS mean, count(*) AS n FROM s GROUP BY k),
d AS (SELECT s.k, s.t, s.v - m.mean AS d FROM s JOIN m USING (k)),
lags AS (SELECT CAST(unnest(range(0, {n})) AS INTEGER) AS lag),
prod AS (SELECT a.k, l.lag, sum(a.d * b.d) AS c FROM d a CROSS JOIN lags l JOIN d b ON b.k = a.k AND b.t = a.t + l.lag
         GROUP BY a.k, l.lag),
r AS (SELECT p.k, p.lag, p.c / max(CASE WHEN p.lag = 0 THEN p.c END) OVER (PARTITION BY p.k) AS acf, m.n
      FROM prod p JOIN m USING (k))
"""


@register("acf", _ACF_CTE.format(n=NLAGS + 1) + """
SELECT k, lag, round(acf, 6) AS acf,
       round(1.959963984540054 * sqrt(CASE WHEN lag = 0 THEN 0.0 ELSE (1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
             OVER (PARTITION BY k ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n END), 6) AS band
FROM r""")
def acf(spark, sf):
    a = ts.acf(_series(spark, sf), "v", "k", NLAGS)
    return a.select("k", "lag", F.round("acf", 6).alias("acf"), F.round("band", 6).alias("band"))


@register("pacf", _ACF_CTE.format(n=3) + """
, w AS (SELECT k, max(CASE WHEN lag = 1 THEN acf END) AS r1, max(CASE WHEN lag = 2 THEN acf END) AS r2 FROM r GROUP BY k)
SELECT k, 0 AS lag, 1.0 AS pacf FROM w
UNION ALL SELECT k, 1, round(r1, 6) FROM w
UNION ALL SELECT k, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) FROM w""")
def pacf(spark, sf):
    p = ts.pacf(ts.acf(_series(spark, sf), "v", "k", 2), "k")
    return p.select("k", "lag", F.round("pacf", 6).alias("pacf"))


@register("pacf_full", _ACF_CTE.format(n=NLAGS + 1) + f"""
, rl AS (SELECT k, list(acf ORDER BY lag) AS r FROM r GROUP BY k),
dl AS (
  SELECT k, 1 AS lag, [r[2]] AS phi, r FROM rl
  UNION ALL
  SELECT k, lag + 1, list_concat(list_transform(range(1, lag + 1), lambda j: phi[j] - pkk * phi[lag + 1 - j]), [pkk]), r
  FROM (SELECT *, (r[lag + 2] - list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[lag + 2 - j])))
                  / (1 - list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[j + 1]))) AS pkk
        FROM dl WHERE lag < {NLAGS}))
SELECT k, 0 AS lag, 1.0 AS pacf FROM rl
UNION ALL SELECT k, CAST(lag AS INTEGER), round(phi[lag], 6) FROM dl""")
def pacf_full(spark, sf):
    p = ts.pacf(ts.acf(_series(spark, sf), "v", "k", NLAGS), "k")
    return p.select("k", "lag", F.round("pacf", 6).alias("pacf"))


def _crit_sql(level_coeffs, name):
    b0, b1, b2, b3 = level_coeffs
    inv = "(1.0 / nobs)"
    return f"round({b0} + {b1} * {inv} + {b2} * {inv} * {inv} + {b3} * {inv} * {inv} * {inv}, 6) AS {name}"


@register("unit_root_lag0", f"""
, s AS (SELECT k, y / 1e6 AS v, lag(y / 1e6) OVER (PARTITION BY k ORDER BY dt) AS y1 FROM series_long),
g AS (SELECT k, count(*) AS nobs, regr_slope(v - y1, y1) AS b, regr_sxx(v - y1, y1) AS sxx,
             regr_syy(v - y1, y1) AS syy, regr_sxy(v - y1, y1) AS sxy FROM s WHERE y1 IS NOT NULL GROUP BY k)
SELECT k, nobs, round(b / sqrt((syy - b * sxy) / (nobs - 2) / sxx), 6) AS stat,
       {_crit_sql(ts.MACKINNON_C['1%'], 'crit_1')}, {_crit_sql(ts.MACKINNON_C['5%'], 'crit_5')},
       {_crit_sql(ts.MACKINNON_C['10%'], 'crit_10')}
FROM g""")
def unit_root_lag0(spark, sf):
    u = ts.unit_root_lag0(_series(spark, sf), "v", "k")
    return u.select("k", "nobs", *[F.round(c, 6).alias(c) for c in ("stat", "crit_1", "crit_5", "crit_10")])


@register("unit_root_aic", f"""
, g AS (SELECT k, CAST(count(*) - 1 AS BIGINT) AS n_rows, least(CAST(ceil(12.0 * pow(count(*) / 100.0, 0.25)) AS BIGINT), count(*) // 2 - 2) AS most
        FROM series_long GROUP BY k)
SELECT k, n_rows, true AS valid FROM g""")
def unit_root_aic(spark, sf):
    """H1 with AIC lag selection: every key has a finite statistic, critical values in order, a lag
    within its bound and rows = days - 1 - lag (the statistic itself: ``unit_root_lag0`` and tests)."""
    u = ts.unit_root_aic(_series(spark, sf), "v", "k")
    n = (F.col("nobs") + F.col("used_lag") + 1).cast("double")
    most = F.least(F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / 2) - 2)
    valid = (F.col("used_lag").between(0, most) & (F.abs("stat") < float("inf"))
             & (F.col("crit_1") < F.col("crit_5")) & (F.col("crit_5") < F.col("crit_10")))
    return u.select("k", (F.col("nobs") + F.col("used_lag")).cast("long").alias("n_rows"), valid.alias("valid"))


# y in millions with the day's number of orders; differences and their lags
_ARX_CTE = """
, x AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS dt,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1e6 AS y, CAST(count(*) AS DOUBLE) AS n
        FROM orders GROUP BY 1, 2),
dx AS (SELECT k, dt, y, n, row_number() OVER w AS pos, lag(y) OVER w AS y1, y - lag(y) OVER w AS dy,
              lag(y) OVER w - lag(y, 2) OVER w AS d1 FROM x WINDOW w AS (PARTITION BY k ORDER BY dt))
"""


@register("order_search", _ARX_CTE + ", " + order_search_sql("x", "k", "dt", "y", ["n"], 5))
def order_search(spark, sf):
    """H4 over p = 0..5 on the long series."""
    o = ts.order_search(fx.series_x(spark, sf), "y", "k", ["n_orders"], max_p=5)
    return o.select("k", "p", F.round("aic", 3).alias("aic"), "nobs")


@register("order_search_p1", _ARX_CTE + """
, c AS (SELECT k, count(*) AS m, var_pop(n) AS nn, var_pop(d1) AS dd, covar_pop(n, d1) AS nd, covar_pop(dy, n) AS yn,
               covar_pop(dy, d1) AS yd, var_pop(dy) AS yy FROM dx WHERE d1 IS NOT NULL GROUP BY k),
s AS (SELECT k, m, m * (yy - yn * yn / nn) AS sse0,
             m * (yy - ((yn * dd - yd * nd) * yn + (yd * nn - yn * nd) * yd) / (nn * dd - nd * nd)) AS sse1 FROM c),
a AS (SELECT k, m, m * ln(sse0 / m) + 4 AS aic0, m * ln(sse1 / m) + 6 AS aic1 FROM s)
SELECT k, CAST(CASE WHEN aic1 < aic0 THEN 1 ELSE 0 END AS INTEGER) AS p, round(least(aic0, aic1), 3) AS aic,
       CAST(m AS INTEGER) AS nobs FROM a""")
def order_search_p1(spark, sf):
    """H4 over p = 0 and 1, whose least squares have a closed form."""
    o = ts.order_search(fx.series_x(spark, sf), "y", "k", ["n_orders"], max_p=1)
    return o.select("k", "p", F.round("aic", 3).alias("aic"), "nobs")


_WF_CTE = f"""
, s AS (SELECT k, dt, y / 1e6 AS v, row_number() OVER w AS pos, lag(y / 1e6) OVER w AS y1
        FROM series_long WINDOW w AS (PARTITION BY k ORDER BY dt)),
f AS (SELECT k, dt, v, pos, y1, regr_slope(v, y1) OVER p AS slope, regr_intercept(v, y1) OVER p AS icpt
      FROM s WINDOW p AS (PARTITION BY k ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
wf AS (SELECT k, dt, v, icpt + slope * y1 AS yhat FROM f WHERE pos > {TRAIN_DAYS})
"""


def _wf(spark, sf):
    return ts.walk_forward_1lag(_series(spark, sf), "v", "k", TRAIN_DAYS)


@register("walk_forward_1lag", _WF_CTE + "SELECT k, CAST(dt AS VARCHAR) AS dt, v, round(yhat, 6) AS yhat FROM wf")
def walk_forward_1lag(spark, sf):
    w = _wf(spark, sf)
    return w.select("k", F.col("dt").cast("string").alias("dt"), "v",
                    F.round("yhat", 6).alias("yhat"))


@register("walk_forward_arx", _ARX_CTE + f"""
, u AS (SELECT * FROM dx WHERE d1 IS NOT NULL),
c AS (SELECT *, var_pop(n) OVER p AS nn, var_pop(d1) OVER p AS dd, covar_pop(n, d1) OVER p AS nd, covar_pop(dy, n) OVER p AS yn,
             covar_pop(dy, d1) OVER p AS yd, avg(n) OVER p AS mn, avg(d1) OVER p AS md, avg(dy) OVER p AS my
      FROM u WINDOW p AS (PARTITION BY k ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, (yn * dd - yd * nd) / (nn * dd - nd * nd) AS bn, (yd * nn - yn * nd) / (nn * dd - nd * nd) AS bd
      FROM c WHERE pos > {TRAIN_DAYS})
SELECT k, CAST(dt AS VARCHAR) AS dt, y, round(y1 + my + bn * (n - mn) + bd * (d1 - md), 5) AS yhat FROM b""")
def walk_forward_arx(spark, sf):
    w = ts.walk_forward_arx(fx.series_x(spark, sf), "y", "k", ["n_orders"], TRAIN_DAYS, p=1)
    return w.select("k", F.col("dt").cast("string").alias("dt"), "y", F.round("yhat", 5).alias("yhat"))


@register("walk_forward_arx3", _ARX_CTE + ", " + walk_forward_sql("x", "k", "dt", "y", ["n"], TRAIN_DAYS, 3) + """
SELECT k, CAST(dt AS VARCHAR) AS dt, y, round(yhat, 5) AS yhat FROM wf_p""")
def walk_forward_arx3(spark, sf):
    """H5 with three lags, the series split into blocks of 500 rows."""
    w = ts.walk_forward_arx(fx.series_x(spark, sf), "y", "k", ["n_orders"], TRAIN_DAYS, p=3, block_rows=500)
    return w.select("k", F.col("dt").cast("string").alias("dt"), "y", F.round("yhat", 5).alias("yhat"))


@register("running_metrics", _WF_CTE + """
, rm AS (SELECT k, dt, count(*) OVER c AS n, sum((v - yhat) * (v - yhat)) OVER c AS sse,
                sum(v) OVER c AS sy, sum(v * v) OVER c AS syy
         FROM wf WINDOW c AS (PARTITION BY k ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT k, CAST(dt AS VARCHAR) AS dt, round(sqrt(sse / n), 6) AS run_rmse,
       round(CASE WHEN n > 1 THEN 1.0 - sse / (syy - sy * sy / n) END, 6) AS run_r2 FROM rm""")
def running_metrics(spark, sf):
    r = ts.running_metrics(_wf(spark, sf), "v", "k")
    return r.select("k", F.col("dt").cast("string").alias("dt"), F.round("run_rmse", 6).alias("run_rmse"),
                    F.round("run_r2", 6).alias("run_r2"))
