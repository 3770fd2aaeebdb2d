"""Bad-record handling (I8): route each message to 'ok' or a dead-letter reason instead of
printing and dropping it (malformed JSON, a date that can't be read, null numerics, text empty after
cleaning)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_expr
from ..sources.files import decode_json

NUMERIC = ["open", "high", "low", "close", "volume"]


def classify_messages(raw: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    m = decode_json(raw, schema, col, corrupt="_corrupt")
    null_num = None
    for c in NUMERIC:
        null_num = F.col(c).isNull() if null_num is None else (null_num | F.col(c).isNull())
    reason = (F.when(F.col("_corrupt").isNotNull(), F.lit("bad_json"))
              .when(F.try_to_timestamp(F.col("dt"), F.lit("yyyy-MM-dd")).isNull(), F.lit("bad_date"))
              .when(null_num, F.lit("null_numeric"))
              .when(F.coalesce(clean_expr(F.col("tweet")), F.lit("")) == "", F.lit("empty_text"))
              .otherwise(F.lit("ok")))
    return m.withColumn("reason", reason)


def split_batch(batch: DataFrame, ok_path: str, dead_path: str, batch_id: int) -> None:
    """foreachBatch body: good rows and dead letters to two tables, keyed by batch id so a
    replayed batch overwrites its own output (idempotent)."""
    batch = batch.persist()
    batch.filter("reason = 'ok'").drop("_corrupt").write.mode("overwrite").parquet(f"{ok_path}/batch={batch_id}")
    batch.filter("reason <> 'ok'").write.mode("overwrite").parquet(f"{dead_path}/batch={batch_id}")
    batch.unpersist()


def ok_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The good records of a raw stream, typed."""
    return classify_messages(raw, schema).filter("reason = 'ok'").select(*schema.fieldNames())
