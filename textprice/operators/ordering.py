"""Sort, limit, positional and window operators.

Positional numbering over a whole table is done without a single-partition window and without
Python: ``prefix_sum`` takes narrow rows (keys, order columns, an id), range-partitions them on the
ordering (the sampler splits a hot key across partitions because the ordering has a tie-breaker),
writes each row's partition number once, and adds window sums within (partition, key) to
offsets from a small table of (partition, key) totals.

Windows that look a fixed number of rows back (``halo_blocks``) are cut by position: a key's series goes in
blocks of ``block_rows`` rows, and each block is also given the rows before it that its windows reach into.
So one key's series, however long, is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_sum(df: DataFrame, order_cols, partition_cols=(), weight: str | None = None,
               out: str = "cum_before", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 if None) over the rows before this one in
    (``partition_cols``, ``order_cols``) order, within each partition key (null is a key).

    ``order_cols`` must make the order total (end with a unique column).  Give it narrow rows: they
    are sorted and written once; wide columns are joined back by the caller (``row_index``)."""
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    partition_cols = list(partition_cols)
    n = num_partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    # Rows and totals must see the same partition numbers: written once to the shared folder.
    tagged = (df.withColumn("_w", w).repartitionByRange(n, *partition_cols, *order_cols)
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    before = Window.partitionBy("_pid", *partition_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_local", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    totals = tagged.groupBy("_pid", *partition_cols).agg(F.sum("_w").alias("_tot"))
    earlier = Window.partitionBy(*partition_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_pid").alias("_p"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(partition_cols)],
                            F.coalesce(F.sum("_tot").over(earlier), F.lit(0)).alias("_offset"))
    same = F.col("_pid") == F.col("_p")
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return local.join(offsets, same).select(*df.columns, (F.col("_offset") + F.col("_local")).cast("long").alias(out))


def row_index(df: DataFrame, order_cols, partition_cols=(), name: str = "row_idx", id_col: str = "doc_id",
              start: int = 1, descending: bool = False) -> DataFrame:
    """Position in (``partition_cols``, ``order_cols``) order (B10), from ``start`` on, distributed.
    ``order_cols`` (names) must make the order total.  Only keys, order columns and the unique
    ``id_col`` are numbered; other columns are joined back by id."""
    parts = [f"_part{i}" for i in range(len(partition_cols))]
    order = [f"_order{i}" for i in range(len(order_cols))]
    keys = df.select(F.col(id_col).alias("_id"), *[F.col(c).alias(p) for c, p in zip(partition_cols, parts)],
                     *[F.col(c).alias(o) for c, o in zip(order_cols, order)])
    sorts = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    numbered = prefix_sum(keys, sorts, parts, None, "_before")
    return (df.join(numbered.select("_id", "_before"), F.col(id_col).eqNullSafe(F.col("_id")))
            .select(*df.columns, (F.col("_before") + start).alias(name)))


def sort_by_date(df: DataFrame, descending: bool = False) -> DataFrame:
    """Sort by (dt, doc_id); doc_id breaks ties."""
    if descending:
        return df.orderBy(F.col("dt").desc(), F.col("doc_id").desc())
    return df.orderBy("dt", "doc_id")


def head_n(df: DataFrame, n: int = 5, order=("dt", "doc_id")) -> DataFrame:
    """First n rows by key (plans to TakeOrderedAndProject: top-n per partition, then merge)."""
    return df.orderBy(*order).limit(n)


def latest_posts(df: DataFrame, n: int = 10, per: str | None = None) -> DataFrame:
    """The n most recent posts (intended meaning), globally or per ``per`` key.

    Per key, ``row_number() <= n`` is planned with a window group limit that keeps only n rows
    per key on every map task before the shuffle, so a hot key ships n rows per task."""
    if per is None:
        return df.orderBy(F.col("dt").desc(), F.col("doc_id").desc()).limit(n)
    w = Window.partitionBy(per).orderBy(F.col("dt").desc(), F.col("doc_id").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def tail_posts(df: DataFrame, n: int = 10) -> DataFrame:
    """E4 (literal): the live view sorts newest first and shows the tail -> the n OLDEST posts."""
    return df.orderBy(F.col("dt").asc(), F.col("doc_id").asc()).limit(n)


BLOCK_ROWS = 1 << 16  # rows of one key that one task looks at together


def halo_blocks(series: DataFrame, key: str, order: str, lookback: int, block_rows: int | None = None) -> DataFrame:
    """``series`` with ``_pos`` (position in its key, from 0), ``_block`` (``_pos`` over ``block_rows``) and ``_halo``: the
    last ``lookback`` rows of a block come once more, with ``_halo`` true, in the next one.  Windows by
    (``key``, ``_block``) then see whatever lies up to ``lookback`` rows back.  ``order`` is unique within a key."""
    block_rows = BLOCK_ROWS if block_rows is None else block_rows
    if lookback > block_rows:
        raise ValueError(f"a block of {block_rows} rows can't give {lookback} rows to the next")
    placed = prefix_sum(series, [order], [key], None, "_pos")
    own = F.floor(F.col("_pos") / block_rows)
    late = F.col("_pos") % block_rows >= block_rows - lookback
    return (placed.withColumn("_own", own)
            .withColumn("_block", F.explode(F.when(late, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
            .withColumn("_halo", F.col("_block") != F.col("_own")).drop("_own"))


def own_rows(blocks: DataFrame, *also: str) -> DataFrame:
    """The rows of ``halo_blocks`` without halos and helper columns."""
    return blocks.filter(~F.col("_halo")).drop("_halo", "_block", "_pos", *also)


def rolling_stats(series: DataFrame, value: str, key: str = "symbol", order: str = "dt",
                  window: int = 12, block_rows: int | None = None) -> DataFrame:
    """Rolling mean and sample std over ``window`` rows, null until the window is full."""
    w = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(-(window - 1), 0)
    full = F.count(value).over(w) == window
    return own_rows(halo_blocks(series, key, order, window - 1, block_rows)
                    .withColumn("roll_mean", F.when(full, F.avg(value).over(w)))
                    .withColumn("roll_std", F.when(full, F.stddev_samp(value).over(w))))


def difference(series: DataFrame, value: str, key: str = "symbol", order: str = "dt",
               lag: int = 1, block_rows: int | None = None) -> DataFrame:
    """Lagged value and first difference."""
    prev = F.lag(value, lag).over(Window.partitionBy(key, "_block").orderBy(order))
    return own_rows(halo_blocks(series, key, order, lag, block_rows)
                    .withColumn(f"{value}_lag{lag}", prev).withColumn(f"{value}_diff", F.col(value) - F.col(f"{value}_lag{lag}")))


def chrono_split(series: DataFrame, train_rows: int, key: str = "symbol",
                 order: str = "dt") -> DataFrame:
    """First ``train_rows`` rows of each key's series are 'train', the rest 'test'."""
    return (prefix_sum(series, [order], [key], None, "_before").withColumn("pos", (F.col("_before") + 1).cast("int"))
            .withColumn("part", F.when(F.col("pos") <= train_rows, F.lit("train")).otherwise(F.lit("test"))).drop("_before"))
