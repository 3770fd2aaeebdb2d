"""Correlating the post stream with the prediction stream.

Predictions are first reduced, as a stream, to the last version (largest ``seq``) per (day, md5 of the
text); then posts are joined to them, stream to stream, LEFT OUTER, with watermarks on both sides.
So a post has one match at most: n copies of a text on a day give n rows, however many
predictions there are.  State holds ids, hashes and numbers, no texts, and is bounded by the
watermark (I9); unmatched posts come out once the watermark has passed them.  The delay must cover the
disorder of the replay; rows later than that are counted (``ingest.dropped_rows``).  A prediction that
arrives before its post is kept and matched when the post arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import sentiment_label
from .ingest import with_event_time

LIVE = ("doc_id", "dt", "symbol", "low", "high", "open", "close", "volume")


def last_predictions(preds: DataFrame, delay: str) -> DataFrame:
    """(q_ts, q_h, seq, prediction, pred_close): the last version per day and text hash."""
    q = with_event_time(preds, "dt", "q_ts").withWatermark("q_ts", delay)
    return q.groupBy("q_ts", F.md5("tweet").alias("q_h")).agg(
        F.max("seq").alias("seq"), F.max_by("prediction", "seq").alias("prediction"),
        F.max_by("close", "seq").alias("pred_close"))


def correlate_streams(posts: DataFrame, preds: DataFrame, delay: str = "60 days") -> DataFrame:
    """The live table: each post with its last prediction, or without."""
    p = with_event_time(posts, "dt", "p_ts").withWatermark("p_ts", delay) \
        .select(*[c for c in LIVE if c in posts.columns], "p_ts", F.md5("tweet").alias("p_h"))
    q = last_predictions(preds, delay)
    same = (F.col("p_ts") == F.col("q_ts")) & (F.col("p_h") == F.col("q_h"))
    return p.join(q, same, "leftOuter").drop("p_ts", "p_h", "q_ts", "q_h")


def latest_state(matches: DataFrame) -> DataFrame:
    """The live table with its labels."""
    return matches.withColumn("sentiment", sentiment_label(F.col("prediction"), F.col("pred_close"))) \
        .drop("seq", "pred_close")
