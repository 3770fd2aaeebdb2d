"""Live totals (I6): streaming aggregates in complete mode, materialised per micro-batch to a
table that the dashboard-style queries (D10-D13, E4) read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def symbol_totals(stream: DataFrame) -> DataFrame:
    return stream.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_posts"),
                                        F.sum("volume").alias("sum_volume"))


def write_by_batch(path: str):
    """foreachBatch writer for complete-mode results: each batch is a table of its own (a replayed batch
    overwrites itself), so readers never see a half-written one.  The newest two stay: the one before the
    newest for those who are reading it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")
        jvm, fs = _file_system(batch.sparkSession, path)
        for old in sorted(complete_batches(batch.sparkSession, path))[:-2]:
            fs.delete(jvm.Path(f"{path}/batch-{old}"), True)
    return write


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    return jvm, jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm, fs = _file_system(spark, path)
    return fs.exists(jvm.Path(path))


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that are written to the end."""
    jvm, fs = _file_system(spark, path)
    return [int(s.getPath().getName().split("-")[1]) for s in fs.listStatus(jvm.Path(path))
            if s.getPath().getName().startswith("batch-") and fs.exists(jvm.Path(s.getPath(), "_SUCCESS"))]


def read_committed(spark: SparkSession, path: str, schema, fmt: str = "json") -> DataFrame:
    """All complete batches under ``path``: a batch that failed while it was written is not seen, one that was
    written again is seen once."""
    done = [f"{path}/batch-{i}" for i in sorted(complete_batches(spark, path))]
    return spark.read.schema(schema).format(fmt).load(done) if done else spark.createDataFrame([], schema)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete batch."""
    return spark.read.parquet(f"{path}/batch-{max(complete_batches(spark, path))}")
