"""Streaming source options, correlation, scoring with dead letters, live tables."""

import os
import time

from pyspark.sql import functions as F

from textprice.schemas import POST_MESSAGE_SCHEMA
from textprice.session import scratch_path
from textprice.streaming import ingest


def _msgs(spark, ids):
    return spark.createDataFrame([(i, "2024-01-01", f"t{i}", "s", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for i in ids],
                                 POST_MESSAGE_SCHEMA)


def test_stream_start_at_latest_reads_only_new_files(spark):
    base = scratch_path(spark, "latest")
    src = os.path.join(base, "in")
    ingest.write_messages(_msgs(spark, range(0, 5)), src)
    time.sleep(1.5)
    since = spark.sql("select current_timestamp() as t").first()["t"]
    time.sleep(1.5)
    ingest.write_messages(_msgs(spark, range(5, 9)), src)
    s = ingest.read_messages(spark, src, POST_MESSAGE_SCHEMA, since=since)
    ingest.run_to_table(s.select("doc_id"), os.path.join(base, "out"), os.path.join(base, "ck"))
    got = sorted(r.doc_id for r in spark.read.parquet(os.path.join(base, "out")).collect())
    assert got == [5, 6, 7, 8]
    s_all = ingest.read_messages(spark, src, POST_MESSAGE_SCHEMA)
    ingest.run_to_table(s_all.select("doc_id"), os.path.join(base, "out2"), os.path.join(base, "ck2"))
    assert spark.read.parquet(os.path.join(base, "out2")).count() == 9


def test_dedup_stream_each_id_once(spark):
    base = scratch_path(spark, "dedup")
    src = os.path.join(base, "in")
    ingest.write_messages(_msgs(spark, range(20)), src, 5)
    ingest.write_messages(_msgs(spark, range(10, 30)), src, 5)
    s = ingest.with_event_time(ingest.read_messages(spark, src, POST_MESSAGE_SCHEMA, max_files_per_trigger=2))
    ingest.run_to_table(ingest.dedup_stream(s, "doc_id", "event_ts", "2 days").select("doc_id"),
                        os.path.join(base, "out"), os.path.join(base, "ck"))
    ids = [r.doc_id for r in spark.read.parquet(os.path.join(base, "out")).collect()]
    assert sorted(ids) == list(range(30))


def _preds(spark, rows):
    """(seq, dt, tweet, prediction, close) as prediction messages."""
    from textprice.schemas import PREDICTION_MESSAGE_SCHEMA
    df = spark.createDataFrame(rows, "seq long, dt string, tweet string, prediction double, close double")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in PREDICTION_MESSAGE_SCHEMA.fields])


def _correlate(spark, posts, preds, max_files=None, fail_on_dropped=True):
    """Predictions are delivered first, posts later, then a far-future marker on both sides."""
    from textprice.schemas import PREDICTION_MESSAGE_SCHEMA
    from textprice.streaming import correlate
    base = scratch_path(spark, "corr")
    posts_dir, preds_dir, out = (os.path.join(base, x) for x in ("p", "q", "out"))
    ingest.write_messages(preds, preds_dir)
    time.sleep(1.1)
    ingest.write_messages(posts, posts_dir)
    time.sleep(1.1)
    ingest.write_messages(_msgs(spark, [-1]).withColumn("dt", F.lit("2100-01-01")), posts_dir)
    ingest.write_messages(_preds(spark, [(-1, "2100-01-01", "m", 0.0, 0.0)]), preds_dir)
    ps = ingest.read_messages(spark, posts_dir, POST_MESSAGE_SCHEMA, max_files_per_trigger=max_files)
    qs = ingest.read_messages(spark, preds_dir, PREDICTION_MESSAGE_SCHEMA, max_files_per_trigger=max_files)
    ingest.run_to_table(correlate.correlate_streams(ps, qs, delay="30 days"), out, os.path.join(base, "ck"),
                        fail_on_dropped=fail_on_dropped)
    return correlate.latest_state(spark.read.parquet(out).filter("doc_id >= 0")).collect()


def test_correlate_prediction_before_post_and_last_version_wins(spark):
    posts = _msgs(spark, [1, 2, 3]).withColumn("dt", F.concat(F.lit("2024-01-0"), (F.col("doc_id") + 1).cast("string")))
    preds = _preds(spark, [(1, "2024-01-02", "t1", 2.0, 1.0), (9, "2024-01-02", "t1", 0.5, 1.0), (3, "2024-01-04", "t3", 1.0, 1.0)])
    for max_files in (None, 1):
        state = {r.doc_id: (r.prediction, r.sentiment) for r in _correlate(spark, posts, preds, max_files)}
        assert state == {1: (0.5, "Negative"), 2: (None, None), 3: (1.0, "Neutral")}


def test_correlate_copies_of_a_text_give_one_row_each(spark):
    posts = _msgs(spark, range(40)).withColumn("tweet", F.lit("same"))
    preds = _preds(spark, [(i, "2024-01-01", "same", float(i), 1.0) for i in range(40)])
    rows = _correlate(spark, posts, preds)
    assert len(rows) == 40 and {r.prediction for r in rows} == {39.0}
    assert "tweet" not in rows[0].asDict()


def test_rows_later_than_the_watermark_are_reported(spark):
    import pytest
    base = scratch_path(spark, "late")
    for day in ("2024-06-01", "2024-01-01"):
        ingest.write_messages(_msgs(spark, [1]).withColumn("dt", F.lit(day)), base + "/in")
        time.sleep(1.1)
    s = ingest.with_event_time(ingest.read_messages(spark, base + "/in", POST_MESSAGE_SCHEMA, max_files_per_trigger=1))
    with pytest.raises(RuntimeError, match="later than the watermark"):
        ingest.run_to_table(ingest.dedup_stream(s, "doc_id", "event_ts", "2 days").select("doc_id"), base + "/out", base + "/ck",
                            fail_on_dropped=True)


def test_bad_dates_and_records_are_routed_not_raised(spark):
    from textprice.streaming import deadletter
    good = '{"doc_id":1,"dt":"2024-01-01","tweet":"hi","open":1,"high":1,"low":1,"close":1,"volume":1}'
    raw = spark.createDataFrame([(good,), (good.replace("2024-01-01", "soon"),), (good[:-9],), (good.replace('"open":1', '"open":null'),),
                                 (good.replace('"hi"', '"#x"'),), (good.replace('"hi"', '"!"'),)], "value string")
    reasons = [r.reason for r in deadletter.classify_messages(raw, POST_MESSAGE_SCHEMA).collect()]
    assert reasons == ["ok", "bad_date", "bad_json", "null_numeric", "empty_text", "empty_text"]
    df = spark.createDataFrame([("nonsense",), ("2024-01-01",)], "dt string")
    assert [r.event_ts is None for r in ingest.with_event_time(df).collect()] == [True, False]


def test_complete_mode_tables_are_read_whole(spark):
    from textprice.streaming import kpis
    base = scratch_path(spark, "kpis")
    for day in ("2024-01-01", "2024-01-02"):
        # one file: with more tasks than rows some files would be empty, and one could be batch 0
        ingest.write_messages(_msgs(spark, range(5)).withColumn("dt", F.lit(day)).coalesce(1), base + "/in")
        time.sleep(1.1)
    s = ingest.read_messages(spark, base + "/in", POST_MESSAGE_SCHEMA, max_files_per_trigger=1)
    ingest.run_foreach_batch(kpis.symbol_totals(s), kpis.write_by_batch(base + "/out"), base + "/ck", "complete")
    assert kpis.read_newest(spark, base + "/out").first()["n_posts"] == 10
    assert spark.read.parquet(base + "/out/batch-0").first()["n_posts"] == 5


def test_only_the_newest_two_totals_stay(spark):
    from textprice.streaming import kpis
    base = scratch_path(spark, "kpis-kept")
    write = kpis.write_by_batch(base)
    for i in range(5):
        write(spark.range(i + 1).groupBy().count(), i)
    assert sorted(kpis.complete_batches(spark, base)) == [3, 4]
    assert kpis.read_newest(spark, base).first()[0] == 5


def test_processing_time_trigger_runs_until_stopped(spark):
    base = scratch_path(spark, "continuous")
    src = os.path.join(base, "in")
    ingest.write_messages(_msgs(spark, range(12)), src, 4)
    s = ingest.read_messages(spark, src, POST_MESSAGE_SCHEMA, max_files_per_trigger=1)
    q = ingest.start_continuous(s.select("doc_id"), os.path.join(base, "out"), os.path.join(base, "ck"), "1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(os.path.join(base, "out")).count() == 12
