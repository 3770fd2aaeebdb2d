"""Continuous scoring (I2): the saved pipeline (cleaning included) applied to every
micro-batch as a whole — one Spark job per batch, not per message.  Bad records go to a
dead-letter table; a prediction message is the whole post message, the post's id as version number, and
the prediction."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.embedding import drop_rows, rows_written
from ..schemas import POST_MESSAGE_SCHEMA, PREDICTION_MESSAGE_SCHEMA
from ..session import exchanges_dropped, stored
from . import deadletter, ingest


def prediction_messages(posts: DataFrame, model: PipelineModel) -> DataFrame:
    """The posts that the pipeline scores, whole, with their predictions."""
    columns = POST_MESSAGE_SCHEMA.fieldNames()
    return model.transform(posts.select(*columns)).select(F.col("doc_id").alias("seq"), *columns, "prediction")


def score_messages(raw: DataFrame, model: PipelineModel, out: str, dead: str, checkpoint: str,
                   trigger: dict | None = None) -> None:
    """Run: good records of the raw stream scored into ``out/batch-<id>`` as JSON messages, the others
    with their reason into ``dead/batch-<id>``.  A replayed batch overwrites its own files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        before = len(rows_written())
        with stored(batch, "scored-batch") as batch, exchanges_dropped(batch.sparkSession):
            good = batch.filter("reason = 'ok'").select(*POST_MESSAGE_SCHEMA.fieldNames())
            prediction_messages(good, model).select(*PREDICTION_MESSAGE_SCHEMA.fieldNames()) \
                .write.mode("overwrite").option("compression", "gzip").json(f"{out}/batch-{batch_id}")
            batch.filter("reason <> 'ok'").write.mode("overwrite").parquet(f"{dead}/batch-{batch_id}")
            drop_rows(batch.sparkSession, before)

    ingest.run_foreach_batch(deadletter.classify_messages(raw, POST_MESSAGE_SCHEMA), write, checkpoint, trigger=trigger)
