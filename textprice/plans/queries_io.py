"""Registered source/sink queries (A1-A6, A9, A10, E3, E5, I1).  Written tables go to fresh
paths under the session's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import stats
from ..schemas import POST_MESSAGE_SCHEMA
from ..session import scratch_path
from ..sources import files, paging
from ..sources import fixtures as fx
from ..streaming import kpis
from ..streaming import ingest
from .catalog import register
from .queries_relational import POSTS_SQL, ROLLUP_SQL, _posts_out
from .oracle import fingerprint_sql


@register("scan_csv_schema", POSTS_SQL.format(src="posts"))
def scan_csv_schema(spark, sf):
    path = files.write_csv(fx.posts(spark, sf), scratch_path(spark, "posts-csv"))
    return _posts_out(files.read_posts_csv(spark, path, multi_line=True))


@register("scan_csv_inferred", POSTS_SQL.format(src="posts"))
def scan_csv_inferred(spark, sf):
    path = files.write_csv(fx.posts(spark, sf), scratch_path(spark, "posts-csv"))
    df = files.read_csv_inferred(spark, path, multi_line=True)
    return _posts_out(df.withColumn("doc_id", F.col("doc_id").cast("long"))
                      .withColumn("dt", F.col("dt").cast("string")))


@register("scan_parquet", """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, close FROM posts WHERE symbol = 'click' AND dt >= DATE '2024-01-15'""")
def scan_parquet(spark, sf):
    path = files.write_parquet(fx.posts(spark, sf), scratch_path(spark, "posts-parquet"), partition_by=["dt"])
    df = files.read_parquet(spark, path)
    return df.filter((F.col("symbol") == "click") & (F.col("dt") >= F.lit("2024-01-15").cast("date"))) \
        .select("doc_id", F.col("dt").cast("string").alias("dt"), "close")


@register("sink_parquet", POSTS_SQL.format(src="posts"))
def sink_parquet(spark, sf):
    p = fx.posts(spark, sf)
    path = scratch_path(spark, "sink-parquet")
    files.write_parquet(p.limit(0), path)      # an older table at the same place ...
    files.write_parquet(p, path)               # ... is replaced, not appended to
    return _posts_out(files.read_parquet(spark, path))


@register("sink_csv", ROLLUP_SQL.format(t="tweet", fp=fingerprint_sql("tweet"), src="posts"))
def sink_csv(spark, sf):
    daily = stats.daily_rollup(fx.posts(spark, sf))
    path = files.write_csv(daily, scratch_path(spark, "daily-csv"), reference_names=False)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "dt" else f.dataType, True)
                           for f in daily.schema.fields])
    return spark.read.schema(schema).options(**files.CSV_OPTIONS).csv(path)


@register("json_decode", POSTS_SQL.format(src="posts"))
def json_decode(spark, sf):
    msgs = files.encode_json(fx.posts(spark, sf), drop=())
    back = files.decode_json(msgs, POST_MESSAGE_SCHEMA)
    return _posts_out(back)


@register("json_encode", """
SELECT doc_id, 9 AS n_keys, false AS has_id, md5(tweet) AS tweet_md5, close FROM posts""")
def json_encode(spark, sf):
    enc = files.encode_json(fx.posts(spark, sf), drop=("doc_id",))
    keys = F.json_object_keys("value")
    return enc.select("doc_id", F.size(keys).alias("n_keys"), F.array_contains(keys, "doc_id").alias("has_id"),
                      F.md5(F.get_json_object("value", "$.tweet")).alias("tweet_md5"),
                      F.get_json_object("value", "$.close").cast("double").alias("close"))


_PAGE_SQL = """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, CAST(row_number() OVER (ORDER BY dt, doc_id) AS INTEGER) AS page_pos
FROM (SELECT * FROM posts WHERE symbol = 'click' ORDER BY dt DESC, doc_id DESC LIMIT 100 OFFSET {off})"""


@register("page_first", _PAGE_SQL.format(off=0))
def page_first(spark, sf):
    pg = paging.page(fx.posts(spark, sf), "click", 100)
    return pg.select("doc_id", F.col("dt").cast("string").alias("dt"), "page_pos")


@register("page_next", _PAGE_SQL.format(off=100))
def page_next(spark, sf):
    p = fx.posts(spark, sf)
    first = paging.page(p, "click", 100)
    cursor = paging.next_cursor(first)
    pg = paging.page(p, "click", 100, after=cursor)
    return pg.select("doc_id", F.col("dt").cast("string").alias("dt"), "page_pos")


@register("paged_backfill", """
SELECT doc_id, symbol, CAST(r // 100 AS INTEGER) AS page_no, CAST(r % 100 AS INTEGER) AS from_newest
FROM (SELECT doc_id, symbol, row_number() OVER (PARTITION BY symbol ORDER BY dt DESC, doc_id DESC) - 1 AS r FROM posts)""")
def paged_backfill(spark, sf):
    """Every symbol's history cut into pages (newest first) in one distributed pass and
    laid out as one table ordered by symbol and page, which ``replay_next_page`` reads.  Read back."""
    path = paging.lay_out_pages(fx.posts(spark, sf), 100, scratch_path(spark, "backfill"))
    return spark.read.parquet(path).select("doc_id", "symbol", "page_no", F.col("_from_newest").alias("from_newest"))


@register("paged_replay", """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, CAST(r // 100 AS INTEGER) AS page_no FROM (
  SELECT doc_id, dt, row_number() OVER (ORDER BY dt DESC, doc_id DESC) - 1 AS r FROM posts WHERE symbol = 'view')""")
def paged_replay(spark, sf):
    """I1 incremental: pages are laid out once; each replay run writes the next pages after the stored
    cursor as message files, until none is left (the reference's fetch loop, without its timer); the
    message stream then reads all pages."""
    folder, p = scratch_path(spark, "replay"), fx.posts(spark, sf)
    layout = paging.lay_out_pages(p, 100, scratch_path(spark, "replay-layout"))
    while paging.replay_next_pages(spark, layout, "view", folder) is not None:
        pass
    schema = T.StructType([*POST_MESSAGE_SCHEMA.fields, T.StructField("page_no", T.IntegerType())])
    s = ingest.read_messages(spark, f"{folder}/pages", schema)
    out = ingest.run_to_table(s.select("doc_id", "dt", "page_no"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(out)


@register("paged_stream", """
SELECT doc_id, symbol, CAST(dt AS VARCHAR) AS dt, CAST(r // 50 AS INTEGER) AS page_no FROM (
  SELECT doc_id, symbol, dt, row_number() OVER (PARTITION BY symbol ORDER BY dt DESC, doc_id DESC) - 1 AS r FROM posts)""")
def paged_stream(spark, sf):
    """All symbols' pages as a stream whose offset is the page, run after run from the stored offset."""
    layout = paging.lay_out_pages(fx.posts(spark, sf), 50, scratch_path(spark, "page-layout"))
    out, checkpoint = scratch_path(spark, "page-stream"), scratch_path(spark, "page-offsets")
    paging.run_all_pages(spark, layout, out, checkpoint)
    schema = spark.read.parquet(layout).schema
    return kpis.read_committed(spark, out, schema).select("doc_id", "symbol", "dt", "page_no")
