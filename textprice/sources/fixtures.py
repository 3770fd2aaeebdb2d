"""Derived views that give the reference's record shapes from the driver's tables.

The reference ships no data; these views (see FIXTURES.md) build the same shapes:

* ``bars``     – one daily bar per (symbol, day) from ``events``: first/last value by
  (ts, event_id), max, min, exact decimal sum as volume.  One hash aggregate with partial
  (map-side) aggregation; ``min_by``/``max_by`` on one decimal (time, then id) replace per-day
  row numbering, so no window sorts a hot (symbol, day) group in one task.
* ``docs``     – documents assigned to a symbol and a day by a rule on ``doc_id``.
* ``posts``    – docs joined with their day's bar (the reference's joined training input).
* ``posts_dirty``, ``posts_marked``, ``predictions``, ``lexicon``, ``series_long`` – the
  quality, cleaning, correlation, sentiment and long-series fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..operators.textops import learn_lexicon
from .tables import spread, table

# Fixed values of the fixture rules (FIXTURES.md): symbols by doc_id % 5, 30 days from 2024-01-01.
SYMBOLS = ["click", "error", "purchase", "signup", "view"]
FIRST_DAY = "2024-01-01"
N_DAYS = 30
MARK_PREFIX = " :smile_face: http://ex.am/p @user #tag 5% $abc "


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    # one number per event, ordered by time, then id (a struct would need a sort aggregate)
    order = (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(17,0)")
             * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col("event_id").cast("decimal(19,0)"))
    return (ev.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("dt"))
            .agg(F.min_by("value", order).alias("open"),
                 F.max("value").alias("high"),
                 F.min("value").alias("low"),
                 F.max_by("value", order).alias("close"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("volume")))


def symbol_of(doc_id: F.Column) -> F.Column:
    expr = None
    for i, s in enumerate(SYMBOLS):
        cond = (doc_id % len(SYMBOLS)) == i
        expr = F.when(cond, F.lit(s)) if expr is None else expr.when(cond, F.lit(s))
    return expr


def day_of(doc_id: F.Column) -> F.Column:
    offset = (F.floor(doc_id / len(SYMBOLS)) % N_DAYS).cast("int")
    return F.date_add(F.lit(FIRST_DAY).cast("date"), offset)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Text work downstream is CPU-heavy: spread a scan that came back in fewer splits than
    # cores (no-op for a large table, which already has many splits).
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return d.select("doc_id", F.col("text").alias("tweet"),
                    symbol_of(F.col("doc_id")).alias("symbol"), day_of(F.col("doc_id")).alias("dt"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with their same-day bar (F4); adaptive execution broadcasts the bars if it measures them
    small, otherwise a shuffle join whose skew it splits."""
    b = bars(spark, sf_dir)
    joined = join_small(docs(spark, sf_dir), b, ["symbol", "dt"], "inner")
    return joined.select("doc_id", "dt", "tweet", "symbol", "open", "high", "low", "close",
                         F.col("close").alias("adj_close"), "volume")


def posts_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = posts(spark, sf_dir)
    i = F.col("doc_id")
    t = p.select("doc_id", "dt",
                 F.when(i % 29 == 0, F.lit("")).otherwise(F.col("tweet")).alias("tweet"),
                 "symbol", "open", "high", "low",
                 F.when(i % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("close")).alias("close"),
                 F.when(i % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("adj_close")).alias("adj_close"),
                 "volume")
    return t.unionByName(t.filter(i % 10 == 0))


def posts_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = posts(spark, sf_dir)
    marked = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(MARK_PREFIX), F.col("tweet"))) \
        .otherwise(F.col("tweet"))
    return p.withColumn("tweet", marked)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction messages: a first version for 3 of 4 posts, a later one (higher seq) for some."""
    p = posts(spark, sf_dir)
    i = F.col("doc_id")
    # both versions from ONE pass over the posts (0, 1 or 2 messages per post)
    versions = F.array(
        F.when(i % 4 != 0, F.struct((i * 2).alias("seq"), F.col("open").alias("prediction"))),
        F.when(i % 8 == 1, F.struct((i * 2 + 1).alias("seq"), F.col("close").alias("prediction"))))
    return p.select("dt", "tweet", "close", F.explode(versions).alias("v")) \
        .filter(F.col("v").isNotNull()).select("v.seq", "dt", "tweet", "v.prediction", "close")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon learnt from the documents and what their symbols' closes did next."""
    return learn_lexicon(docs(spark, sf_dir), bars(spark, sf_dir))


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series: order value per (priority, day)."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias("k"), F.to_date("o_orderdate").alias("dt"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("y")))


def series_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series with an exogenous column: order value (in millions) and the number
    of orders per (priority, day)."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias("k"), F.to_date("o_orderdate").alias("dt"))
            .agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 1e6).alias("y"),
                 F.count(F.lit(1)).cast("double").alias("n_orders")))
