"""Aggregation and descriptive statistics.

All aggregates are partial (map-side combine), so a symbol or day holding a third of the rows
is pre-reduced on every map task before the shuffle.  Nothing is collected per group: the
daily roll-up keeps counts, first bar values and an order-free fingerprint of the day's posts
instead of a list, and exact quantiles come from distributed prefix sums over pre-aggregated
(value, count) pairs.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_small
from .ordering import prefix_sum

BAR_COLS = ["open", "high", "low", "close", "adj_close", "volume"]


def text_fingerprint(c) -> F.Column:
    """Order-free fingerprint term of one text: first 32 bits of its md5 as a number.
    Summed over a group it identifies the multiset of texts (same rule in the SQL oracle)."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def first_non_null(col: str, order: str = "doc_id") -> F.Column:
    """First non-null value in ``order`` (pandas ``first``), as a partial aggregate."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order)))


def distinct_count(df: DataFrame, col: str, approx_rsd: float | None = None) -> DataFrame:
    """Number of distinct values (exact, or HyperLogLog++ with ``approx_rsd``)."""
    agg = F.approx_count_distinct(col, approx_rsd) if approx_rsd else F.countDistinct(col)
    return df.agg(agg.cast("long").alias("n_distinct"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """D3."""
    return df.select(col).distinct()


def group_share(df: DataFrame, col: str) -> DataFrame:
    """Count per value with percentage of all rows, largest first.  The total is one row, joined to the
    counts."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(df.agg(F.count(F.lit(1)).alias("_all")))  # one row
    pct = F.lit(100.0).cast("double") * F.col("n") / F.col("_all")
    return g.join(total).withColumn("pct", F.round(pct, 6)).drop("_all").orderBy(F.col("n").desc(), F.col(col))


def count_per_day(df: DataFrame, keys=("symbol", "dt"), name: str = "n_day") -> DataFrame:
    """Group count attached to every row, null keys being a group as in ``groupBy`` (grouped, then
    joined back null-safe; a hot key is split by AQE's skew join)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)) \
        .select(*[F.col(k).alias(f"_{k}") for k in keys], name)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(counts, same).drop(*[f"_{k}" for k in keys])


def daily_rollup(posts: DataFrame, keys=("symbol", "dt")) -> DataFrame:
    """One row per (symbol, day): number of posts (= list length), the first
    non-null of each bar column, the length of the day's joined text and its fingerprint."""
    aggs = [F.count(F.lit(1)).alias("n_posts")]
    aggs += [first_non_null(c).alias(c) for c in BAR_COLS if c in posts.columns]
    aggs += [(F.sum(F.length("tweet")) + F.count("tweet") - 1).cast("long").alias("text_chars"),
             F.sum(text_fingerprint(F.col("tweet"))).cast("long").alias("text_fp")]
    return posts.groupBy(*keys).agg(*aggs)


def corr_matrix(df: DataFrame, cols, by=("symbol",)) -> DataFrame:
    """Pearson correlation of every column pair over the rows that have both, in long form (a, b, r), one
    aggregate; NaN, as in SQL, if one of them does not vary (``corr`` divides by 0 there, an error in ANSI mode), null for
    fewer than two rows."""
    pairs = [(a, b) for a, b in combinations(cols, 2)]

    def corr(a, b):
        a, b = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        r = F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b)))
        return F.when(F.count(a) > 1, F.coalesce(r, F.lit(float("nan"))))

    wide = df.groupBy(*by).agg(*[corr(a, b).alias(f"r__{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `r__{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(*by, f"stack({len(pairs)}, {stack}) as (col_a, col_b, r)")


def corr_matrix_wide(df: DataFrame, cols, method: str = "pearson") -> DataFrame:
    """D8 for many columns: one distributed pass of ``ml.stat.Correlation`` over the assembled
    vectors (rows with a null are skipped); the k x k result (bounded by the column count) is
    returned in long form (col_a, col_b, r) for a < b."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    vec = VectorAssembler(inputCols=list(cols), outputCol="_v", handleInvalid="skip").transform(df.select(*cols))
    m = Correlation.corr(vec, "_v", method).first()[0].toArray()
    rows = [(a, b, float(m[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def exact_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas/numpy 'linear') for several columns.

    Duplicates are pre-aggregated to (column, value, count); cumulative counts come from the
    distributed ``prefix_sum`` (no single-partition sort, no per-group value buffer); only the
    two neighbours of every requested rank are kept.  Result: (col_name, p, q)."""
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) as (col_name, v)").filter(F.col("v").isNotNull())
    vc = long.groupBy("col_name", "v").agg(F.count(F.lit(1)).alias("cnt"))
    cum = prefix_sum(vc, ["v"], ["col_name"], "cnt", "before")
    n = cum.groupBy("col_name").agg(F.max(F.col("before") + F.col("cnt")).alias("n"))
    ranks = n.select("col_name", "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")) \
        .withColumn("h", (F.col("n") - 1) * F.col("p")) \
        .withColumn("lo", F.floor("h").cast("long")).withColumn("hi", F.ceil("h").cast("long"))
    # A value covers ranks [before, before + cnt).  ``ranks`` has len(cols) * len(probs) rows
    # (size bound by construction), so it is broadcast and every value row is checked locally.
    r = F.broadcast(ranks).alias("r")
    c = cum.alias("c")
    covers = lambda k: (F.col(f"r.{k}") >= F.col("c.before")) & (F.col(f"r.{k}") < F.col("c.before") + F.col("c.cnt"))
    hits = c.join(r, (F.col("c.col_name") == F.col("r.col_name")) & (covers("lo") | covers("hi")))
    q = hits.groupBy(F.col("r.col_name").alias("col_name"), F.col("r.p").alias("p"),
                     F.col("r.h").alias("h"), F.col("r.lo").alias("lo")).agg(
        F.max(F.when(covers("lo"), F.col("c.v"))).alias("v_lo"),
        F.max(F.when(covers("hi"), F.col("c.v"))).alias("v_hi"))
    return q.select("col_name", "p",
                    (F.col("v_lo") + (F.col("h") - F.col("lo")) * (F.col("v_hi") - F.col("v_lo"))).alias("q"))


def describe_numeric(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact), max per column, long form."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__count`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in cols)
    basic = wide.selectExpr(f"stack({len(cols)}, {stack}) as (col_name, cnt, mean, std, min_v, max_v)")
    q = exact_quantiles(df, cols).groupBy("col_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("p50"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("p75"))
    return basic.join(q, "col_name", "left")


def histogram(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """Equal-width histograms of several columns in one pass over a stacked form.
    Bin i covers [min + i*w, min + (i+1)*w); the maximum falls in the last bin."""
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) as (metric, v)").filter(F.col("v").isNotNull())
    rng = long.groupBy("metric").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = join_small(long, rng, ["metric"], "inner")
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"),
                F.lit(bins - 1)))
    return j.withColumn("bin", b).groupBy("metric", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")) \
        .select("metric", "bin", "n",
                (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"))


def metric_stats(df: DataFrame, col: str, by=()) -> DataFrame:
    """Mean, population std, max, min of a list of metric values."""
    g = df.groupBy(*by) if by else df
    return g.agg(F.avg(col).alias("avg_metric"), F.stddev_pop(col).alias("std_metric"),
                 F.max(col).alias("max_metric"), F.min(col).alias("min_metric"))


def sentiment_counts(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """Counts per label; rows without a label are not counted."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def live_kpis(df: DataFrame, with_labels: bool = False) -> DataFrame:
    """Posts so far, scored posts, mean prediction (0 when none); optionally
    the label counts (D10) in the same single aggregate."""
    aggs = [F.count(F.lit(1)).alias("n_posts"), F.count("prediction").alias("n_scored"),
            F.coalesce(F.avg("prediction"), F.lit(0.0)).alias("mean_prediction")]
    if with_labels:
        aggs += [F.count_if(F.col("sentiment") == s).alias(f"n_{s.lower()}")
                 for s in ("Positive", "Negative", "Neutral")]
    return df.agg(*aggs)
