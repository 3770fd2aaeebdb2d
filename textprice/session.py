"""Session helpers: building a session, the shared checkpoint folder, scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# Settings every session of this library relies on.  AQE re-plans joins (broadcast when a
# shuffle stage turns out small, splits skewed partitions) and coalesces small partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (joins, de-duplication) kept in RocksDB: spills to local disk instead
    # of holding all keys on the JVM heap.
    STATE_STORE:
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "textprice", driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the cluster's own session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    Only a local session (tests) that names none gets a fresh local folder; on a cluster, where
    executors would not see it, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.split("[")[0] == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textprice-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streaming queries started inside keep their state in RocksDB, whatever the session names: a query takes the
    session's settings when it starts, so the session's own are put back at once."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, SESSION_DEFAULTS[STATE_STORE])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def exchanges_dropped(spark: SparkSession):
    """A table that is written inside leaves no exchange files when it is done; they would else stay until the driver
    happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that was written to the scratch folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written tables and stream state."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "textprice-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def stored(df: DataFrame, name: str):
    """``df`` as a table, for as long as it is needed: cached rows would take several times its space on disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        with exchanges_dropped(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def cluster_settings(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 ** 2,
                     max_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input on ``cores`` cores.

    Shuffle partitions are sized so that an average post-shuffle partition is about
    ``target_partition_bytes`` (never fewer than 2x the cores); AQE then coalesces small ones
    and splits skewed ones.  Scan splits are ``max_partition_bytes``.  E.g. 100 TB on 8,000
    cores -> ~400k shuffle partitions, coalesced at run time."""
    shuffle = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
