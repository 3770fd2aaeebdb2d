"""Keyset-paged reads (A4, E3, E5) and the paged backfill layout.

A page is the top-n of one symbol in (dt desc, doc_id desc) order strictly after a cursor,
returned oldest first; the cursor moves back in time.  The filter is on stored columns
(pushed to the scan) and the top-n plans to TakeOrderedAndProject."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import row_index


def page(df: DataFrame, symbol: str, n: int, after=None) -> DataFrame:
    """One page; ``after`` = (dt, doc_id) of the previous page's oldest row, or None."""
    f = df.filter(F.col("symbol") == F.lit(symbol))
    if after is not None:
        d, i = after
        d = d if isinstance(d, F.Column) else F.lit(d)
        f = f.filter((F.col("dt") < d) | ((F.col("dt") == d) & (F.col("doc_id") < F.lit(i))))
    top = f.orderBy(F.col("dt").desc(), F.col("doc_id").desc()).limit(n)
    pos = F.row_number().over(Window.orderBy("dt", "doc_id"))   # over the n-row page only
    return top.withColumn("page_pos", pos)


def next_cursor(page_df: DataFrame):
    """(dt, doc_id) of the oldest row of a page — one row to the driver, or None when empty."""
    row = page_df.orderBy("dt", "doc_id").select("dt", "doc_id").first()
    return None if row is None else (row["dt"], row["doc_id"])


def page_numbers(df: DataFrame, n: int, key: str = "symbol") -> DataFrame:
    """All pages of every key in ONE distributed pass: position in (dt desc, doc_id desc)
    order per key -> page number and position inside the page (from the newest)."""
    ranked = row_index(df, ["dt", "doc_id"], [key], "_rank", start=0, descending=True)
    return ranked.withColumn("page_no", F.floor(F.col("_rank") / n).cast("int")) \
        .withColumn("_from_newest", (F.col("_rank") % n).cast("int")).drop("_rank")


def lay_out_pages(df: DataFrame, n: int, path: str, key: str = "symbol") -> str:
    """Every key's pages as one table ordered by (key, page).  Range partitioning splits a hot key
    over several writers, and the order lets a reader of one page skip all other row groups."""
    pages = page_numbers(df, n, key).withColumn("dt", F.col("dt").cast("string"))
    pages.repartitionByRange(key, "page_no").sortWithinPartitions(key, "page_no", "_from_newest") \
        .write.mode("overwrite").parquet(path)
    return path


def replay_next_page(spark: SparkSession, layout: str, symbol: str, folder: str):
    """One replay run: the symbol's next page of the laid-out table (the one after the stored cursor) is
    written as JSON messages under ``pages/page_no=k`` (overwritten, so a rerun after a failure writes
    the same page), then the cursor moves.  Returns the page number, or None when none is left."""
    last = _cursor(spark, folder, "page_no int")
    page_no = 0 if last is None else last["page_no"] + 1
    rows = spark.read.parquet(layout).filter((F.col("symbol") == symbol) & (F.col("page_no") == page_no)).drop("page_no")
    if rows.isEmpty():
        return None
    rows.write.mode("overwrite").json(f"{folder}/pages/page_no={page_no}")
    spark.createDataFrame([(page_no,)], "page_no int").coalesce(1).write.mode("append").json(f"{folder}/_cursor")
    return page_no


def replay_next_pages(spark: SparkSession, layout: str, symbol: str, folder: str, rows: int = 1 << 20):
    """One replay run over many pages: the symbol's next pages after the stored cursor, as many as some ``rows`` rows fill
    (at least one), are written as ``replay_next_page`` writes one, then the cursor moves behind them.  A rerun after a failure writes the
    same pages.  Returns the last page's number, or None when none is left."""
    last = _cursor(spark, folder, "page_no int")
    first = 0 if last is None else last["page_no"] + 1
    mine = spark.read.parquet(layout).filter((F.col("symbol") == symbol) & (F.col("page_no") >= first))
    left = mine.agg(F.max("page_no").alias("page_no"), F.count(F.lit(1)).alias("n")).first()
    if left["page_no"] is None:
        return None
    page_no = min(left["page_no"], first + max(1, rows * (left["page_no"] - first + 1) // left["n"]) - 1)
    mine.filter(F.col("page_no") <= page_no).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("page_no").json(f"{folder}/pages")
    spark.createDataFrame([(page_no,)], "page_no int").coalesce(1).write.mode("append").json(f"{folder}/_cursor")
    return page_no


def _cursor(spark: SparkSession, folder: str, schema: str):
    """The newest stored cursor, or None before the first run; any other read error is raised."""
    try:
        return spark.read.schema(schema).json(f"{folder}/_cursor").orderBy(F.col("page_no").desc()).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_next_page(df: DataFrame, symbol: str, n: int, folder: str):
    """I1 incremental replay: fetch the page after the stored cursor, write it as
    ``pages/page_no=k`` (overwrite, so a rerun after a failure rewrites the same page), then
    store the new cursor next to it.  Returns the page number written, or None at the end."""
    spark = df.sparkSession
    last = _cursor(spark, folder, "dt string, doc_id long, page_no int")
    after = None if last is None else (last["dt"], last["doc_id"])
    page_no = 0 if last is None else last["page_no"] + 1
    pg = page(df, symbol, n, None if after is None else (F.lit(after[0]).cast("date"), after[1])).persist()
    cursor = next_cursor(pg)
    if cursor is None:
        pg.unpersist()
        return None
    pg.withColumn("dt", F.col("dt").cast("string")).write.mode("overwrite") \
        .json(f"{folder}/pages/page_no={page_no}")
    spark.createDataFrame([(str(cursor[0]), int(cursor[1]), page_no)], "dt string, doc_id long, page_no int") \
        .write.mode("append").json(f"{folder}/_cursor")
    pg.unpersist()
    return page_no


def run_pages(spark: SparkSession, layout: str, out: str, checkpoint: str, pages: int = 8) -> int:
    """A4/I1 as a stream: one run writes the next ``pages`` pages of every symbol of the laid-out table as JSON messages
    (``out/batch-k``).  Where it stands is the offset of a streaming query, kept in its checkpoint: a run that is
    stopped is finished by the next, which writes the same folder again.  Returns the first page of the run.

    The query's source counts page numbers; the pages themselves are read by a filter on the page number, which
    skips all others' row groups."""
    done = []

    def write(batch: DataFrame, batch_id: int) -> None:
        span = batch.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()  # two numbers
        spark.read.parquet(layout).filter(F.col("page_no").between(span["lo"], span["hi"])) \
            .write.mode("overwrite").json(f"{out}/batch-{batch_id}")
        done.append(span["lo"])

    numbers = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", pages).option("numPartitions", 1).load())
    query = (numbers.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return done[-1]


def run_all_pages(spark: SparkSession, layout: str, out: str, checkpoint: str, pages: int | None = None, rows: int = 1 << 20) -> int:
    """Runs until the last page is written; the number of runs.  Without ``pages``, a run takes as many pages of every symbol
    as some ``rows`` rows fill."""
    last, n = spark.read.parquet(layout).agg(F.max("page_no"), F.count(F.lit(1))).first()
    pages = pages or (max(8, rows * (last + 1) // n) if n else 8)
    runs = 0
    while last is not None:
        runs += 1
        if run_pages(spark, layout, out, checkpoint, pages) + pages > last:
            break
    return runs
