"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join ``big`` with a side that is usually small.  Nothing runs while the plan is built: adaptive
    execution measures the side's finished shuffle and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one stays a shuffle join whose skewed
    partitions are split."""
    return big.join(small, on, how)


def append_rows(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; missing columns become null (F2)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def latest_predictions(preds: DataFrame, seq: str = "seq") -> DataFrame:
    """Prediction versions reduced to the last one (largest ``seq``) per (dt, md5 of the text).

    ``max_by`` of plain numbers is a hash aggregate with map-side combine: a hot key is reduced on
    every map task, and no text is shuffled."""
    return preds.groupBy("dt", F.md5("tweet").alias("_h")).agg(
        F.max_by("prediction", seq).alias("prediction"), F.max_by("close", seq).alias("pred_close"),
        F.max(seq).alias(seq))


def attach_predictions(posts: DataFrame, preds: DataFrame) -> DataFrame:
    """Attach the last prediction to every post with the same (dt, text); unmatched posts kept
    with a null prediction (F1).  Texts are compared by their md5."""
    from ..functions.labels import sentiment_label
    last = latest_predictions(preds).select(F.col("dt").alias("_dt"), "_h", "prediction", "pred_close")
    j = posts.join(last, (posts["dt"] == F.col("_dt")) & (F.md5(posts["tweet"]) == F.col("_h")), "left")
    return j.select(*[posts[c] for c in posts.columns], F.col("prediction"),
                    sentiment_label(F.col("prediction"), F.col("pred_close")).alias("sentiment"))
