"""Message stream source and sinks.

Messages are JSON lines read with a DECLARED schema.  The source format and its options are
arguments, so a broker source can be passed where one is available; tests and the registered
queries use the file source.  "Start at earliest" is the whole backlog; the file source has no
"start at latest", which is a filter on an ingest-time column instead."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import rocksdb_state


def write_messages(df: DataFrame, folder: str, rows_per_file: int = 0, compression: str | None = None) -> str:
    """Write records as JSON-lines message files, one per task, or cut after ``rows_per_file`` rows; ``compression``
    is the codec of the files (a compressed file is read by one task)."""
    w = df.write.mode("append").option("maxRecordsPerFile", rows_per_file)
    (w.option("compression", compression) if compression else w).json(folder)
    return folder


def read_messages(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "json",
                  max_files_per_trigger: int | None = None, options: dict | None = None,
                  since=None, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Message stream with a declared schema.  A micro-batch is bounded by ``max_bytes_per_trigger``
    (for example "64g", by what the cluster takes at once) or a number of files, else it is the
    whole backlog.  ``since`` (a timestamp) starts "at latest":
    only message files written at or after it are read (file modification time from the
    source's ``_metadata``); without it the whole backlog is read ("earliest")."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(folder)
    if since is not None:
        df = df.filter(F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
    return df


def with_event_time(df: DataFrame, date_col: str = "dt", out: str = "event_ts") -> DataFrame:
    """Event time from the message date, as TIMESTAMP (watermarks reject TIMESTAMP_NTZ); null for a
    date that can't be read, which ``deadletter`` routes away."""
    return df.withColumn(out, F.try_to_timestamp(F.col(date_col).cast("string"), F.lit("yyyy-MM-dd")).cast("timestamp"))


def dropped_rows(query) -> int:
    """Rows that a finished query's stateful operators dropped as later than the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def read_raw(spark: SparkSession, folder: str, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Message stream as text lines (column ``value``), for routing bad records."""
    r = spark.readStream.format("text")
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.load(folder)


def run_to_table(stream_df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 output_mode: str = "append", trigger: dict | None = None, query_name: str | None = None,
                 fail_on_dropped: bool = False, keyed_state: bool = False) -> str:
    """Run a streaming query into a file table with a checkpoint (exactly-once file sink).  With
    ``fail_on_dropped``, rows dropped as later than the watermark are an error.  ``keyed_state``: the query has a
    stateful processor, which only the RocksDB state store can hold.
    ``trigger`` defaults to availableNow (drain the backlog, then stop); a continuous
    processing-time run is ``start_continuous``."""
    w = stream_df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    with rocksdb_state(stream_df.sparkSession) if keyed_state else nullcontext():
        q = w.start(path)
    q.awaitTermination()
    if fail_on_dropped and dropped_rows(q):
        raise RuntimeError(f"{dropped_rows(q)} rows were later than the watermark and were dropped")
    return path


def start_continuous(stream_df: DataFrame, path: str, checkpoint: str, interval: str = "5 seconds",
                     fmt: str = "parquet", output_mode: str = "append", query_name: str | None = None):
    """Start a processing-time query (poll interval ``interval``) and return its handle;
    the caller stops it (``processAllAvailable()`` then ``stop()`` in tests)."""
    w = (stream_df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
         .trigger(processingTime=interval))
    if query_name:
        w = w.queryName(query_name)
    return w.start(path)


def run_foreach_batch(stream_df: DataFrame, fn, checkpoint: str, output_mode: str = "append",
                      trigger: dict | None = None) -> None:
    """Run with a ``foreachBatch`` sink; ``fn(batch_df, batch_id)`` must be idempotent per id."""
    q = (stream_df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(fn).trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination()


def dedup_stream(df: DataFrame, id_col: str, event_time: str, delay: str) -> DataFrame:
    """Each id once although the source may deliver it again (within the watermark)."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_col])
