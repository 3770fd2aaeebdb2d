"""The live view by keyed state, and the running distributions."""

import pytest
from pyspark.sql import functions as F

from textprice.schemas import POST_MESSAGE_SCHEMA, PREDICTION_MESSAGE_SCHEMA
from textprice.session import scratch_path
from textprice.streaming import distributions, ingest, kpis, liveview


def post(i, dt="2024-01-01", tweet=None):
    return (i, dt, tweet or f"text {i}", "s", 1.0, 2.0, 0.5, 1.5, 1.5, 10.0)


def pred(seq, tweet, prediction, dt="2024-01-01", close=1.5):
    return (seq, None, dt, tweet, "s", 1.0, 2.0, 0.5, close, 1.5, 10.0, prediction)


class Run:
    def __init__(self, spark, salts=3, delay="10 days"):
        self.spark, self.base, self.salts, self.delay = spark, scratch_path(spark, "live-test"), salts, delay
        for folder, schema in (("in", POST_MESSAGE_SCHEMA), ("in2", PREDICTION_MESSAGE_SCHEMA)):
            ingest.write_messages(spark.createDataFrame([], schema), f"{self.base}/{folder}")

    def send(self, posts=(), preds=()):
        for folder, rows, schema in (("in", posts, POST_MESSAGE_SCHEMA), ("in2", preds, PREDICTION_MESSAGE_SCHEMA)):
            if rows:
                ingest.write_messages(self.spark.createDataFrame(list(rows), schema).coalesce(1), f"{self.base}/{folder}")
        log = liveview.live_versions(ingest.read_messages(self.spark, f"{self.base}/in", POST_MESSAGE_SCHEMA),
                                     ingest.read_messages(self.spark, f"{self.base}/in2", PREDICTION_MESSAGE_SCHEMA), self.delay, self.salts)
        w = log.writeStream.format("parquet").option("checkpointLocation", f"{self.base}/ck").trigger(availableNow=True)
        self.query = w.start(f"{self.base}/out")
        self.query.awaitTermination()
        return {r.doc_id: (r.prediction, r.sentiment) for r in liveview.live_rows(self.spark, f"{self.base}/out").collect()}

    def versions(self):
        log = self.spark.read.schema(liveview.VIEW_SCHEMA).parquet(f"{self.base}/out")
        return {r.doc_id: r.n for r in log.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_post_at_once_then_prediction_then_newer_prediction(spark):
    run = Run(spark)
    assert run.send([post(1), post(2), post(3, tweet="copy"), post(4, tweet="copy")]) == {i: (None, None) for i in (1, 2, 3, 4)}
    got = run.send(preds=[pred(7, "text 1", 2.0), pred(8, "copy", 1.0)])
    assert {i: p for i, (p, _) in got.items()} == {1: 2.0, 2: None, 3: 1.0, 4: 1.0}
    got = run.send(preds=[pred(9, "text 1", 1.5), pred(6, "copy", 9.0), pred(8, "copy", 1.0)])  # newer, older, replayed
    assert {i: p for i, (p, _) in got.items()} == {1: 1.5, 2: None, 3: 1.0, 4: 1.0}
    assert run.versions() == {1: 3, 2: 1, 3: 2, 4: 2}
    # a prediction before its post, and a replayed post
    got = run.send([post(1)], [pred(11, "text 5", 3.0)])
    assert 5 not in got
    got = run.send([post(5), post(6, tweet="copy"), post(7, "2024-01-02", "copy")])
    assert got[5][0] == 3.0 and got[6][0] == 1.0 and got[7][0] is None
    assert run.versions()[1] == 3 and run.versions()[5] == 1


def test_state_ends_and_late_rows_are_counted(spark):
    run = Run(spark, salts=1, delay="5 days")
    run.send([post(1)], [pred(1, "text 1", 2.0)])
    run.send([post(2, "2024-03-01")])           # the watermark passes the first day's timer
    run.send([post(3, "2024-03-02")])
    rows = [op["numRowsTotal"] for p in run.query.recentProgress for op in p["stateOperators"]]
    got = run.send([post(9, "2024-01-01", "text 1")])
    assert 9 not in got and ingest.dropped_rows(run.query) >= 1
    assert got[1][0] == 2.0 and set(got) == {1, 2, 3}
    assert rows and rows[-1] < 12  # posts, predictions and timers of the last two days only


def test_delay_is_in_days(spark):
    with pytest.raises(ValueError):
        liveview.live_versions(None, None, "5 hours")


def test_running_distributions_by_micro_batch(spark):
    base = scratch_path(spark, "dist-test")
    rows = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("2024-01-01").alias("dt"), (F.col("id") % 7).cast("double").alias("low"),
                                   F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("prediction"),
                                   F.when(F.col("id") % 3 == 0, "Positive").when(F.col("id") % 3 == 1, "Negative").alias("sentiment"))
    rows.where("doc_id < 300").coalesce(1).write.parquet(f"{base}/in")

    def run():
        s = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        ingest.run_foreach_batch(distributions.running_state(s, ["low", "prediction"]), kpis.write_by_batch(f"{base}/out"), f"{base}/ck", "complete")
        s = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        ingest.run_foreach_batch(s, distributions.write_latest(f"{base}/latest", 4), f"{base}/ck2")
        state = kpis.read_newest(spark, f"{base}/out").first()
        return (state.n_posts, state.n_positive, state.n_negative, state.n_neutral, state.prediction__n, state.prediction__hi), \
            sorted(r.doc_id for r in kpis.read_newest(spark, f"{base}/latest").collect())

    assert run() == ((300, 100, 100, 0, 150, 298.0), [296, 297, 298, 299])
    rows.where("doc_id >= 300").coalesce(1).write.mode("append").parquet(f"{base}/in")
    assert run() == ((900, 300, 300, 0, 450, 898.0), [896, 897, 898, 899])
    rows.where("doc_id = 0").coalesce(1).write.mode("append").parquet(f"{base}/in")  # an early post comes last
    assert run()[1] == [896, 897, 898, 899]


def test_pages_go_on_from_the_stored_offset(spark):
    from textprice.sources import paging
    posts = spark.range(230).selectExpr("id AS doc_id", "date_add(DATE '2024-01-01', CAST(id % 9 AS INT)) AS dt",
                                        "CASE WHEN id < 200 THEN 'hot' ELSE 'cold' END AS symbol", "CAST(id AS STRING) AS tweet")
    layout = paging.lay_out_pages(posts, 20, scratch_path(spark, "pages"))
    out, ck = scratch_path(spark, "pages-out"), scratch_path(spark, "pages-ck")
    schema = spark.read.parquet(layout).schema
    assert paging.run_pages(spark, layout, out, ck, 4) == 0
    first = kpis.read_committed(spark, out, schema)
    assert first.count() == 4 * 20 + 30 and first.agg(F.max("page_no")).first()[0] == 3
    assert paging.run_pages(spark, layout, out, ck, 4) == 4
    assert paging.run_all_pages(spark, layout, out, ck, 4) == 1
    rows = kpis.read_committed(spark, out, schema)
    assert rows.count() == 230 and rows.select("doc_id").distinct().count() == 230


def test_failed_batches_are_not_seen_and_replayed_ones_once(spark):
    base = scratch_path(spark, "committed")
    rows = spark.range(10).selectExpr("id AS doc_id")
    assert kpis.exists(spark, base) is False
    for i in (0, 1, 1):
        rows.write.mode("overwrite").json(f"{base}/batch-{i}")
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    rows.write.json(f"{base}/batch-2")
    fs.delete(jvm.Path(f"{base}/batch-2/_SUCCESS"), False)  # as if the batch had failed after its tasks
    assert kpis.read_committed(spark, base, "doc_id long").count() == 20
    rows.write.mode("overwrite").json(f"{base}/batch-2")
    assert kpis.read_committed(spark, base, "doc_id long").count() == 30


def test_live_view_in_a_session_with_another_state_store(spark):
    from textprice.session import STATE_STORE
    base, other = scratch_path(spark, "live-store"), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    ingest.write_messages(spark.createDataFrame([post(1), post(2)], POST_MESSAGE_SCHEMA).coalesce(1), f"{base}/in")
    ingest.write_messages(spark.createDataFrame([pred(7, "text 1", 2.0)], PREDICTION_MESSAGE_SCHEMA).coalesce(1), f"{base}/in2")
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, other)
    try:
        log = liveview.live_versions(ingest.read_messages(spark, f"{base}/in", POST_MESSAGE_SCHEMA),
                                     ingest.read_messages(spark, f"{base}/in2", PREDICTION_MESSAGE_SCHEMA))
        ingest.run_to_table(log, f"{base}/out", f"{base}/ck", fail_on_dropped=True, keyed_state=True)
        assert spark.conf.get(STATE_STORE) == other
    finally:
        spark.conf.set(STATE_STORE, before)
    assert {r.doc_id: r.prediction for r in liveview.live_rows(spark, f"{base}/out").collect()} == {1: 2.0, 2: None}


def test_replay_runs_write_many_pages(spark):
    from textprice.sources import paging
    posts = spark.range(230).selectExpr("id AS doc_id", "date_add(DATE '2024-01-01', CAST(id % 9 AS INT)) AS dt",
                                        "CASE WHEN id < 200 THEN 'hot' ELSE 'cold' END AS symbol", "CAST(id AS STRING) AS tweet")
    layout, by_one, by_many = paging.lay_out_pages(posts, 20, scratch_path(spark, "replay")), scratch_path(spark, "one"), scratch_path(spark, "many")
    while paging.replay_next_page(spark, layout, "hot", by_one) is not None:
        pass
    assert paging.replay_next_pages(spark, layout, "hot", by_many, rows=60) == 2
    assert paging.replay_next_pages(spark, layout, "hot", by_many, rows=1) == 3  # one page at least
    assert paging.replay_next_pages(spark, layout, "hot", by_many) == 9
    assert paging.replay_next_pages(spark, layout, "hot", by_many) is None
    rows = [sorted(spark.read.json(f"{f}/pages").select("page_no", "doc_id", "dt", "tweet").collect()) for f in (by_one, by_many)]
    assert rows[0] == rows[1] and len(rows[0]) == 200
    # the stream's runs are sized by rows, too: 1,000 rows are not 8 pages a run
    wide = paging.lay_out_pages(posts, 1, scratch_path(spark, "replay"))
    out = scratch_path(spark, "replay-out")
    assert paging.run_all_pages(spark, wide, out, scratch_path(spark, "replay-ck")) == 1
    assert kpis.read_committed(spark, out, spark.read.parquet(wide).schema).count() == 230


def test_compressed_messages_are_read(spark):
    base = scratch_path(spark, "gz")
    ingest.write_messages(spark.createDataFrame([post(1), post(2)], POST_MESSAGE_SCHEMA), f"{base}/in", compression="gzip")
    ingest.run_to_table(ingest.read_messages(spark, f"{base}/in", POST_MESSAGE_SCHEMA), f"{base}/out", f"{base}/ck")
    assert spark.read.parquet(f"{base}/out").count() == 2
