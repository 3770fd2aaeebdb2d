"""Loading the driver's parquet tables.

Reads go through ``spark.read.parquet`` so that column pruning and filter pushdown reach the
scan.  ``spread`` hash-partitions a scan that came back with fewer partitions than the
cluster has cores (a single-row-group file gives one task) so that CPU-heavy text work is
spread; a scan of a large table already has many splits and is left alone (no extra shuffle).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when it has fewer partitions than the cluster cores."""
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
