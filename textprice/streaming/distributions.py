"""Running distributions of the live view (D10-D13, E4, I6), renewed with every micro-batch.

Totals, label counts and one quantile sketch per metric are the state of a streaming aggregate: partial aggregation on
every task, one row of state whatever has passed, no range needed in advance.  The latest rows are kept by merging a batch's
latest with those before it.  Each micro-batch writes the whole state as a small table of its own
(``kpis.write_by_batch``); readers take the newest complete one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import latest_posts
from ..operators.sketches import K, sketch_aggregates
from . import kpis

METRICS = ("low", "high", "open", "close", "volume", "prediction")
LABELS = ("Positive", "Negative", "Neutral")


def running_state(rows: DataFrame, metrics=METRICS, k: int = K) -> DataFrame:
    """One row: totals, label counts and a sketch per metric (``sketches.sketch_aggregates``) of all rows so far; ``rows``
    may be a stream."""
    counts = [F.count_if(F.col("sentiment") == s).alias(f"n_{s.lower()}") for s in LABELS]
    return rows.groupBy().agg(F.count(F.lit(1)).alias("n_posts"), *counts, *sketch_aggregates(metrics, k))


def write_latest(path: str, n: int = 10):
    """foreachBatch writer: the ``n`` latest rows (by dt, doc_id) of this batch and of the newest batch before it."""
    write = kpis.write_by_batch(path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [i for i in kpis.complete_batches(spark, path) if i < batch_id] if kpis.exists(spark, path) else []
        rows = latest_posts(batch, n)
        if before:
            rows = latest_posts(rows.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/batch-{max(before)}")), n)
        write(rows, batch_id)

    return merge
