"""The live flow end to end (I2 -> I4 -> I5 -> I6): post messages are scored by the saved
pipeline as a stream whose prediction messages land in a second message folder, bad records in a
dead-letter table; a second streaming query correlates posts with predictions (stream-stream outer
join) into the live table; the live totals, histograms and latest rows are ordinary queries over it."""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import latest_posts
from ..operators.stats import histogram, live_kpis
from ..schemas import POST_MESSAGE_SCHEMA, PREDICTION_MESSAGE_SCHEMA
from . import correlate, deadletter, ingest, score

HISTOGRAMS = ["low", "high", "open", "close", "volume"]


def run_live(spark: SparkSession, post_folder: str, model: PipelineModel, work_dir: str,
             delay: str = "60 days", max_bytes_per_trigger: str | None = None, trigger: dict | None = None) -> str:
    """Runs both streaming queries; returns the path of the live table (append-only)."""
    pred_folder, live = os.path.join(work_dir, "predictions"), os.path.join(work_dir, "live")
    # 1) scoring: prediction message = the post message + prediction (one prediction per scored post)
    raw = ingest.read_raw(spark, post_folder, max_bytes_per_trigger)
    score.score_messages(raw, model, pred_folder, os.path.join(work_dir, "dead"),
                         os.path.join(work_dir, "ck-score"), trigger=trigger)
    # 2) correlation of the good posts with the prediction stream
    ps = deadletter.ok_messages(ingest.read_raw(spark, post_folder, max_bytes_per_trigger), POST_MESSAGE_SCHEMA)
    qs = ingest.read_messages(spark, os.path.join(pred_folder, "*"), PREDICTION_MESSAGE_SCHEMA,
                              max_bytes_per_trigger=max_bytes_per_trigger)
    ingest.run_to_table(correlate.correlate_streams(ps, qs, delay), live, os.path.join(work_dir, "ck-live"),
                        trigger=trigger, fail_on_dropped=True)
    return live


def live_state(spark: SparkSession, live_path: str) -> DataFrame:
    """The live table: one row per post with its last prediction and label."""
    return correlate.latest_state(spark.read.parquet(live_path).filter(F.col("doc_id") >= 0))


def live_totals(spark: SparkSession, live_path: str) -> DataFrame:
    return live_kpis(live_state(spark, live_path), with_labels=True)


def live_histograms(state: DataFrame, bins: int = 10) -> DataFrame:
    """The five histograms of the live view."""
    return histogram(state, HISTOGRAMS, bins)


def live_latest(state: DataFrame, n: int = 10) -> DataFrame:
    """The latest ``n`` rows of the live view."""
    return latest_posts(state, n)
