"""Distributions from mergeable quantile sketches (D9, D13, I6): one KLL sketch per column and group, merged later.

A sketch of parameter ``k`` holds a bounded number of values; its ranks are off by at most ``RANK_ERROR`` of the rows
(with k = 800; 99 % confidence for one rank).  Sketches of days, partitions or micro-batches are
merged by aggregation, so a range of days, or a stream so far, is read from sketches alone.  Counts, minimum,
maximum and mean are exact.  Columns without a value have no sketch, and null quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800
GRID = 1000  # ranks at which a histogram reads a sketch
RANK_ERROR = 0.0065  # of a rank, and of a share between two ranks, for k = 800


def sketch_aggregates(cols, k: int = K) -> list:
    """The aggregates ``c__n``, ``c__sum``, ``c__lo``, ``c__hi`` and ``c__sketch`` of every column ``c``; also on streams."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        aggs += [F.count(v).alias(f"{c}__n"), F.sum(v).alias(f"{c}__sum"), F.min(v).alias(f"{c}__lo"), F.max(v).alias(f"{c}__hi"),
                 F.kll_sketch_agg_double(v, k).alias(f"{c}__sketch")]
    return aggs


def sketch_columns(df: DataFrame, cols, by=(), k: int = K) -> DataFrame:
    """One row of ``sketch_aggregates`` per group."""
    return df.groupBy(*by).agg(*sketch_aggregates(cols, k))


def merge_sketches(sketches: DataFrame, cols, by=()) -> DataFrame:
    """The sketches of several groups as one per ``by``."""
    aggs = []
    for c in cols:
        aggs += [F.sum(f"{c}__n").alias(f"{c}__n"), F.sum(f"{c}__sum").alias(f"{c}__sum"), F.min(f"{c}__lo").alias(f"{c}__lo"),
                 F.max(f"{c}__hi").alias(f"{c}__hi"), F.kll_merge_agg_double(f"{c}__sketch").alias(f"{c}__sketch")]
    return sketches.groupBy(*by).agg(*aggs)


def long_form(sketches: DataFrame, cols, by=()) -> DataFrame:
    """(by, metric, n, total, lo, hi, sketch): a row per column."""
    parts = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__sum").alias("total"),
                               F.col(f"{c}__lo").alias("lo"), F.col(f"{c}__hi").alias("hi"), F.col(f"{c}__sketch").alias("sketch")) for c in cols])
    return sketches.select(*by, F.explode(parts).alias("p")).select(*by, "p.*")


def describe_sketches(sketches: DataFrame, cols, by=(), probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """D9 from sketches: (by, metric, n, mean, lo, p25, p50, p75, hi)."""
    some = F.col("n") > 0
    q = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(f"p{round(p * 100)}") for p in probs]
    return long_form(sketches, cols, by).select(*by, "metric", "n", F.try_divide("total", "n").alias("mean"), "lo", *q, "hi")


def histogram_sketches(sketches: DataFrame, cols, by=(), bins: int = 10) -> DataFrame:
    """D13 from sketches: (by, metric, bin, n, bin_start): estimated rows in ``bins`` bins of equal width between the exact
    minimum and maximum."""
    rows = long_form(sketches, cols, by).where("n > 0")
    width = (F.col("hi") - F.col("lo")) / bins
    edge = lambda i: F.col("lo") + i * width
    # share of rows below an edge: of the sketch's quantiles at GRID even ranks, those below it
    ranks = F.lit([(i + 0.5) / GRID for i in range(GRID)])
    rows = rows.withColumn("grid", F.kll_sketch_get_quantile_double("sketch", ranks))
    below = lambda i: F.size(F.filter("grid", lambda q: q < edge(i))) / F.lit(float(GRID))
    rows = rows.withColumn("bin", F.explode(F.array(*[F.lit(i) for i in range(bins)])))
    lower = F.when(F.col("bin") == 0, F.lit(0.0)).otherwise(below(F.col("bin")))
    upper = F.when(F.col("bin") == bins - 1, F.lit(1.0)).otherwise(below(F.col("bin") + 1))
    share = F.when(F.col("hi") == F.col("lo"), F.when(F.col("bin") == 0, 1.0).otherwise(0.0)).otherwise(upper - lower)
    return rows.select(*by, "metric", "bin", (share * F.col("n")).alias("n"), edge(F.col("bin")).alias("bin_start"))


def day_sketches(df: DataFrame, cols, keys=("symbol", "dt"), k: int = K) -> DataFrame:
    """The sketch table: one row per (symbol, day), to be written once and merged for any range of days."""
    return sketch_columns(df, cols, keys, k)


def describe_range(table: DataFrame, cols, first, last, by=("symbol",), day: str = "dt") -> DataFrame:
    """D9 of the days ``first`` to ``last`` from the sketch table alone."""
    days = table.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return describe_sketches(merge_sketches(days, cols, by), cols, by)


def rank_errors(df: DataFrame, told: DataFrame, cols, by=(), probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(by, metric, rank_error): how far the quantiles in ``told`` (``describe_sketches``) are off in rank, at most, among the
    rows of ``df``: the distance of p from the share of rows below and up to the quantile.  One pass and one aggregate."""
    stack = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(*by, F.explode(stack).alias("s")).select(*by, "s.*").where(F.col("v").isNotNull() & ~F.isnan("v"))
    names = [f"p{round(p * 100)}" for p in probs]
    j = long.join(told.select(*by, "metric", *names), [*by, "metric"])
    shares = j.groupBy(*by, "metric").agg(*[F.avg((F.col("v") < F.col(n)).cast("double")).alias(f"{n}_below") for n in names],
                                          *[F.avg((F.col("v") <= F.col(n)).cast("double")).alias(f"{n}_upto") for n in names])
    off = [F.greatest(F.lit(0.0), F.col(f"{n}_below") - p, F.lit(p) - F.col(f"{n}_upto")) for n, p in zip(names, probs, strict=True)]
    return shares.select(*by, "metric", F.greatest(*off).alias("rank_error"))
