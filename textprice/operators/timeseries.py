"""Time-series operators for every key's daily series at once (H1-H6).

One key's series may be very long.  What looks back a fixed number of rows (lags) runs on blocks of a key's
rows with a halo (``ordering.halo_blocks``); what needs all earlier rows (expanding fits, running
metrics) is a segmented scan: sums per block, the sums of earlier blocks from a small table, then running sums
within a block.  Orders are searched on one matrix of lagged cross-products per key.  Only the unit-root test with a
lag search (``unit_root_aic``) gathers a key's series, one row per day.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_small
from .ordering import halo_blocks

# Two-sided 95 % normal quantile (Bartlett band) and MacKinnon (2010)
# response-surface coefficients for the constant-only unit-root test, one regressor:
# critical value = b0 + b1/T + b2/T^2 + b3/T^3 at 1 %, 5 %, 10 %.
Z_975 = 1.959963984540054
MACKINNON_C = {"1%": (-3.43035, -6.5393, -16.786, -79.433),
               "5%": (-2.86154, -2.8903, -4.234, -40.040),
               "10%": (-2.56677, -1.5384, -2.809, 0.0)}


def mackinnon_crit(nobs: F.Column, level: str) -> F.Column:
    b0, b1, b2, b3 = MACKINNON_C[level]
    inv = F.lit(1.0) / nobs
    return F.lit(b0) + F.lit(b1) * inv + F.lit(b2) * inv * inv + F.lit(b3) * inv * inv * inv


def lagged(blocks: DataFrame, value: str, key: str, order: str, lag: int) -> F.Column:
    """``value`` ``lag`` rows back, on rows of ``halo_blocks``."""
    return F.lag(value, lag).over(Window.partitionBy(key, "_block").orderBy(order))


def acf(series: DataFrame, value: str, key: str, nlags: int, order: str = "dt", block_rows: int | None = None) -> DataFrame:
    """H2: autocorrelation for lags 0..nlags with Bartlett half-width of the 95 % band.

    acf(k) = sum_t d_t d_{t-k} / sum_t d_t^2 with d = y - mean (the usual biased estimator).  A block's rows
    with a halo of nlags rows give all lagged products of a row at once; their sums are one partial
    aggregate.  Lags not below the number of rows have no value and no row."""
    s = series.select(key, order, value)
    mean = s.groupBy(key).agg(F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("n"))
    d = join_small(s, mean, [key], "inner").select(key, order, (F.col(value) - F.col("_mean")).alias("d"))
    rows = halo_blocks(d, key, order, nlags, block_rows)
    rows = rows.select(key, "_halo", "d", *[lagged(rows, "d", key, order, k).alias(f"d{k}") for k in range(1, nlags + 1)])
    sums = rows.filter(~F.col("_halo")).groupBy(key).agg(
        F.sum(F.col("d") * F.col("d")).alias("c0"), *[F.sum(F.col("d") * F.col(f"d{k}")).alias(f"c{k}") for k in range(1, nlags + 1)])
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"c{k}").alias("c")) for k in range(nlags + 1)])
    # a constant series has no variance: its autocorrelations are null
    r = join_small(sums, mean.select(key, "n"), [key], "inner").select(key, "n", "c0", F.explode(lags).alias("l")) \
        .filter(F.col("l.lag") < F.col("n")) \
        .select(key, "n", F.col("l.lag").alias("lag"), F.try_divide(F.col("l.c"), F.col("c0")).alias("acf"))
    wk = Window.partitionBy(key).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)  # nlags rows a key
    prev_sq = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(wk), F.lit(0.0))
    var = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise((F.lit(1.0) + 2 * prev_sq) / F.col("n"))
    return r.select(key, "lag", "acf", (F.lit(Z_975) * F.sqrt(var)).alias("band"))


def durbin_levinson(r):
    """Partial autocorrelations from autocorrelations r[0..K] (r[0] = 1)."""
    K = len(r) - 1
    out = [1.0]
    phi_prev: list[float] = []
    for k in range(1, K + 1):
        num = r[k] - sum(phi_prev[j] * r[k - 1 - j] for j in range(k - 1))
        den = 1.0 - sum(phi_prev[j] * r[j + 1] for j in range(k - 1))
        pkk = num / den if den != 0 else float("nan")
        phi = [phi_prev[j] - pkk * phi_prev[k - 2 - j] for j in range(k - 1)] + [pkk]
        out.append(pkk)
        phi_prev = phi
    return out


def pacf(acf_df: DataFrame, key: str) -> DataFrame:
    """H3: partial autocorrelation (Yule-Walker on the acf, Durbin-Levinson), per key on the
    key's <= nlags+1 acf values."""
    kt = acf_df.schema[key].dataType.simpleString()

    def per_key(pdf):
        import pandas as pd
        pdf = pdf.sort_values("lag")
        vals = durbin_levinson(list(pdf["acf"].astype(float)))
        return pd.DataFrame({key: pdf[key].iloc[0], "lag": pdf["lag"].astype("int32").values, "pacf": vals})

    return acf_df.select(key, "lag", "acf").groupBy(key).applyInPandas(
        per_key, f"{key} {kt}, lag int, pacf double")


def unit_root_lag0(series: DataFrame, value: str, key: str, order: str = "dt") -> DataFrame:
    """H1 (no lagged differences): Δy_t = a + b y_{t-1}; statistic b / se(b), pure SQL
    aggregates per key; critical values from the MacKinnon response surface at nobs."""
    rows = halo_blocks(series.select(key, order, value), key, order, 1)
    s = rows.withColumn("y1", lagged(rows, value, key, order, 1)).withColumn("dy", F.col(value) - F.col("y1")) \
        .filter(~F.col("_halo") & F.col("y1").isNotNull())
    g = s.groupBy(key).agg(F.count(F.lit(1)).alias("nobs"), F.regr_slope("dy", "y1").alias("b"),
                           F.regr_sxx("dy", "y1").alias("sxx"), F.regr_syy("dy", "y1").alias("syy"),
                           F.regr_sxy("dy", "y1").alias("sxy"))
    # null for series without a residual degree of freedom or without variance
    se = F.sqrt(F.try_divide(F.try_divide(F.greatest(F.col("syy") - F.col("b") * F.col("sxy"), F.lit(0.0)),
                                          (F.col("nobs") - 2).cast("double")), F.col("sxx")))
    return g.select(key, "nobs", F.when(F.col("nobs") > 2, F.try_divide(F.col("b"), se)).alias("stat"),
                    mackinnon_crit(F.col("nobs"), "1%").alias("crit_1"),
                    mackinnon_crit(F.col("nobs"), "5%").alias("crit_5"),
                    mackinnon_crit(F.col("nobs"), "10%").alias("crit_10"))


def _ols(X, y):
    import numpy as np
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    return beta, float(resid @ resid)


def _adf_design(y, lags, start):
    import numpy as np
    dy = np.diff(y)
    n = len(dy)
    X = np.column_stack([np.ones(n - start), y[start:n], *[dy[start - i:n - i] for i in range(1, lags + 1)]])
    return X, dy[start:]


def adf_autolag(y) -> dict:
    """Augmented unit-root test with the lag count chosen by AIC (maxlag = ceil(12 (n/100)^¼)),
    compared on a common sample, then refitted on all usable rows.  A series of fewer than five values
    or without variance has no statistic (null), like one with missing values."""
    import numpy as np
    y = np.asarray(y, dtype=float)
    n = len(y)
    if n < 5 or not np.isfinite(y).all() or np.ptp(y[:-1]) == 0:
        return {"stat": None, "used_lag": None, "nobs": max(n - 1, 0), "crit_1": None, "crit_5": None, "crit_10": None}
    maxlag = min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2)
    maxlag = max(maxlag, 0)
    best = None
    for lag in range(maxlag + 1):
        X, dy = _adf_design(y, lag, maxlag)
        _, sse = _ols(X, dy)
        m = len(dy)
        aic = m * math.log(sse / m) + 2 * X.shape[1] if sse > 0 else -math.inf
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = best[1]
    X, dy = _adf_design(y, lag, lag)
    beta, sse = _ols(X, dy)
    m, k = X.shape
    var = sse / (m - k) * np.linalg.pinv(X.T @ X)[1, 1] if m > k else 0.0
    stat = beta[1] / math.sqrt(var) if var > 0 else None
    crit = {lvl: b0 + b1 / m + b2 / m ** 2 + b3 / m ** 3 for lvl, (b0, b1, b2, b3) in MACKINNON_C.items()}
    return {"stat": None if stat is None else float(stat), "used_lag": int(lag), "nobs": int(m),
            "crit_1": crit["1%"], "crit_5": crit["5%"], "crit_10": crit["10%"]}


def unit_root_aic(series: DataFrame, value: str, key: str, order: str = "dt") -> DataFrame:
    """H1 with AIC lag selection, per key (applyInPandas on the bounded daily series)."""
    kt = series.schema[key].dataType.simpleString()

    def per_key(pdf):
        import pandas as pd
        pdf = pdf.sort_values(order)
        res = adf_autolag(pdf[value].values)
        return pd.DataFrame([{key: pdf[key].iloc[0], **res}]).astype({"used_lag": "Int32", "nobs": "int32"})

    return series.select(key, order, value).groupBy(key).applyInPandas(
        per_key, f"{key} {kt}, stat double, used_lag int, nobs int, crit_1 double, crit_5 double, crit_10 double")


def arx_rows(series: DataFrame, value: str, key: str, exog, lags: int, order: str, block_rows: int | None) -> DataFrame:
    """Rows of ``halo_blocks`` without halos: ``_y1`` (value before), ``_d0`` (difference), ``_d1``... (differences before), ``exog``
    and ``_full``, whether the row has all of them."""
    rows = halo_blocks(series.select(key, order, value, *exog), key, order, lags + 1, block_rows)
    back = [F.col(value), *[lagged(rows, value, key, order, i) for i in range(1, lags + 2)]]
    rows = rows.select("*", back[1].alias("_y1"), *[(back[i] - back[i + 1]).alias(f"_d{i}") for i in range(lags + 1)])
    full = F.lit(True)
    for c in [*exog, *[f"_d{i}" for i in range(lags + 1)]]:
        full = full & F.col(c).isNotNull()
    return rows.filter(~F.col("_halo")).withColumn("_full", full)


def order_search(series: DataFrame, value: str, key: str, exog, max_p: int = 5,
                 order: str = "dt", block_rows: int | None = None) -> DataFrame:
    """H4 (re-aimed): for d = 1 and p = 0..max_p fit ARX(p) with exogenous columns by least
    squares and keep the p of lowest AIC per key, all p compared on the rows that the largest p
    leaves (rows with a null are left out).

    One aggregate: the covariances of the difference, its max_p lags and the exogenous columns.  With the means taken
    out, every p's residual is that of a part of this matrix, which is small whatever the series' length.
    A p that the series is too short for has no AIC; with none, p is 0 and the AIC null."""
    exog = list(exog)
    kt = series.schema[key].dataType.simpleString()
    cols = [*exog, *[f"_d{i}" for i in range(1, max_p + 1)], "_d0"]
    rows = arx_rows(series, value, key, exog, max_p, order, block_rows)
    rows = rows.select(key, "_full", *[F.when(F.col("_full"), F.col(c).cast("double")).alias(c) for c in cols])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    moments = rows.groupBy(key).agg(F.count_if("_full").cast("int").alias("nobs"), F.array(
        *[F.coalesce(F.covar_pop(cols[i], cols[j]), F.lit(0.0)) for i, j in pairs]).alias("cov"))

    def search(frames):
        import numpy as np
        import pandas as pd
        for pdf in frames:
            out = []
            for k, m, cov in zip(pdf[key], pdf["nobs"], pdf["cov"], strict=True):
                S = np.zeros((len(cols), len(cols)))
                for (i, j), c in zip(pairs, cov, strict=True):
                    S[i, j] = S[j, i] = c
                scale = np.sqrt(np.diag(S))
                scale[scale == 0] = 1.0
                S = S / scale / scale[:, None]
                best = (None, 0)
                for p in range(max_p + 1):
                    x = [*range(len(exog) + p)]
                    beta = np.linalg.lstsq(S[np.ix_(x, x)], S[x, -1], rcond=1e-10)[0] if x else np.empty(0)
                    left = max(float(S[-1, -1] - beta @ S[x, -1]), 0.0) * scale[-1] ** 2
                    if m <= len(x) + 1:
                        continue
                    aic = m * math.log(max(left, 1e-300)) + 2 * (len(x) + 1)
                    if best[0] is None or aic < best[0]:
                        best = (aic, p)
                out.append((k, best[1], best[0], m))
            yield pd.DataFrame(out, columns=[key, "p", "aic", "nobs"])

    return moments.mapInPandas(search, f"{key} {kt}, p int, aic double, nobs int")


def least_squares(xx, xy):
    """Coefficients of many fits from their sums of products, by elimination; a column that depends on those before
    it (constant ones depend on the first) has coefficient 0."""
    import numpy as np
    k = xx.shape[1]
    m = np.concatenate((xx, xy[:, :, None]), axis=2)
    least = 1e-9 * np.maximum(np.einsum("ijj->ij", xx), 1e-300)
    used = np.zeros((len(m), k), dtype=bool)
    for j in range(k):
        pivot = m[:, j, j]
        used[:, j] = pivot > least[:, j]
        row = np.where(used[:, j, None], m[:, j, :] / np.where(used[:, j], pivot, 1)[:, None], 0)
        factor = m[:, :, j].copy()
        factor[:, j] = 0
        m = m - factor[:, :, None] * row[:, None, :]
    return np.where(used, m[:, :, k] / np.where(used, np.einsum("ijj->ij", m[:, :, :k]), 1), 0)


def expanding_fit(rows: DataFrame, key: str, order: str, design, target: str, out: str) -> DataFrame:
    """``rows`` (with ``_pos`` and ``_block``) with ``out``: the prediction of ``target`` from the ``design`` columns by least squares
    over all earlier rows of the key; null while those are not more than the columns.

    A segmented scan: each block's sums of cross-products, the sums of the blocks before it (a small table, one
    row per block and product), then running sums within a block.  A task holds one block."""
    design = list(design)
    k = len(design)
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    products = [F.col(design[i]) * F.col(design[j]) for i, j in pairs] + [F.col(d) * F.col(target) for d in design]
    totals = rows.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(p).alias(f"_s{i}") for i, p in enumerate(products)])
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(key, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), F.array(
        *[F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0.0)) for i in range(len(products))]).alias("_sums"))
    keep = [c for c in rows.columns if c not in (key, "_block")]
    joined = rows.join(before, [key, "_block"]).select(key, "_block", *keep, "_n", "_sums")
    fields = [joined.schema[c] for c in (key, *keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{out}` double"

    def fit(pdf):
        import numpy as np
        pdf = pdf.sort_values(order).reset_index(drop=True)
        A, b = pdf[design].to_numpy(dtype=float), pdf[target].to_numpy(dtype=float)
        sums = np.asarray(pdf["_sums"].iloc[0], dtype=float)
        xtx, xty = np.empty((k, k)), sums[len(pairs):]
        for (i, j), v in zip(pairs, sums, strict=False):
            xtx[i, j] = xtx[j, i] = v
        past = int(pdf["_n"].iloc[0]) + np.arange(len(pdf))
        XX = xtx + np.cumsum(np.einsum("ij,ik->ijk", A, A), axis=0) - np.einsum("ij,ik->ijk", A, A)
        Xy = xty + np.cumsum(A * b[:, None], axis=0) - A * b[:, None]
        yhat = np.full(len(pdf), np.nan)
        ready = np.flatnonzero(past >= k)
        if len(ready):
            yhat[ready] = (A[ready] * least_squares(XX[ready], Xy[ready])).sum(axis=1)
        res = pdf[[f.name for f in fields]].copy()
        res[out] = np.where(past >= k, yhat, np.nan)
        return res

    fitted = joined.groupBy(key, "_block").applyInPandas(fit, schema)
    return fitted.withColumn(out, F.when(~F.isnan(out), F.col(out)))


def running_sums(rows: DataFrame, key: str, order: str, parts: dict, last: int) -> DataFrame:
    """``rows`` (of ``halo_blocks``, without halos) with one column per part: its sum over all rows of the key up to this one
    (``last`` = 0) or the one before (-1): running sums within a block and the sums of the blocks before it (a
    small table, one row per block)."""
    totals = rows.groupBy(key, "_block").agg(*[F.sum(c).alias(f"{n}_before") for n, c in parts.items()])
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(key, "_block", *[F.coalesce(F.sum(f"{n}_before").over(earlier), F.lit(0.0)).alias(f"{n}_before") for n in parts])
    w = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    run = rows.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0.0)).alias(n) for n, c in parts.items()]).join(before, [key, "_block"])
    return run.select(*rows.columns, *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in parts])


def walk_forward_1lag(series: DataFrame, value: str, key: str, train_size: int,
                      order: str = "dt", block_rows: int | None = None) -> DataFrame:
    """H5 (one lag): at every origin t >= train_size regress y on y_{-1} over all
    earlier actual rows and forecast y_t, from running sums (of values less the key's mean, which changes no
    fit but keeps digits)."""
    mean = series.groupBy(key).agg(F.avg(value).alias("_mean"))
    rows = halo_blocks(join_small(series.select(key, order, value), mean, [key], "inner"), key, order, 1, block_rows)
    x = lagged(rows, value, key, order, 1) - F.col("_mean")
    rows = rows.withColumn("_x", x).withColumn("_y", F.col(value) - F.col("_mean")).filter(~F.col("_halo") & (F.col("_pos") > 0))
    x, y = F.col("_x"), F.col("_y")
    s = running_sums(rows, key, order, {"_n": F.lit(1.0), "_sx": x, "_sy": y, "_sxx": x * x, "_sxy": x * y}, -1)
    mx, my = F.try_divide(F.col("_sx"), F.col("_n")), F.try_divide(F.col("_sy"), F.col("_n"))
    # null while the earlier values are constant
    slope = F.try_divide(F.col("_sxy") - F.col("_sx") * my, F.col("_sxx") - F.col("_sx") * mx)
    return s.filter(F.col("_pos") >= train_size).select(key, order, value, (F.col("_mean") + my + slope * (x - mx)).alias("yhat"))


def walk_forward_arx(series: DataFrame, value: str, key: str, exog, train_size: int, p: int = 1,
                     order: str = "dt", block_rows: int | None = None) -> DataFrame:
    """H5 (ARX by least squares): one-step forecasts at every origin after ``train_size`` with
    history growing by the ACTUAL values.  Since history is actuals, the origins are
    independent: cumulative cross-products X'X and X'y give every origin's fit without a
    refit loop.  (The notebook's model is regression with ARIMA errors by maximum likelihood;
    numbers differ by design.)"""
    exog = list(exog)
    rows = arx_rows(series, value, key, exog, p, order, block_rows).filter("_full").withColumn("_one", F.lit(1.0))
    fit = expanding_fit(rows, key, order, ["_one", *[f"_d{i}" for i in range(1, p + 1)], *exog], "_d0", "_step")
    return fit.filter((F.col("_pos") >= train_size) & F.col("_step").isNotNull()) \
        .select(key, order, value, (F.col("_y1") + F.col("_step")).alias("yhat"))


def running_metrics(pred: DataFrame, value: str, key: str, order: str = "dt", block_rows: int | None = None) -> DataFrame:
    """H6: RMSE and R² over the growing prefix of forecasts: running sums within blocks and the sums of the
    blocks before."""
    e2 = (F.col(value) - F.col("yhat")) ** 2
    rows = halo_blocks(pred.select(key, order, value, "yhat"), key, order, 0, block_rows)
    run = running_sums(rows, key, order, {"_sse": e2, "_k": F.when(e2.isNotNull(), 1.0), "_sy": F.col(value),
                                          "_syy": F.col(value) * F.col(value)}, 0)
    n = F.col("_pos") + 1
    sse, sy = F.when(F.col("_k") > 0, F.col("_sse")), F.col("_sy")
    sst = F.col("_syy") - sy * sy / n
    return run.select(key, order, value, "yhat", F.sqrt(sse / n).alias("run_rmse"),
                      # null while the actual values are constant
                      F.when(n > 1, F.lit(1.0) - F.try_divide(sse, F.greatest(sst, F.lit(0.0)))).alias("run_r2"))
