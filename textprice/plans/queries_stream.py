"""Registered streaming queries (A7, A12, I2, I4, I6, I7, I8).  Each writes its input as
message files into a fresh folder under the shared checkpoint folder, runs the stream with
``availableNow`` into a table, and returns the table read back (its end state)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import joins, sketches
from ..schemas import POST_MESSAGE_SCHEMA, PREDICTION_MESSAGE_SCHEMA
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.files import encode_json
from ..streaming import correlate, deadletter, distributions, ingest, kpis, live, liveview, score
from . import preprocessing as pp
from .catalog import register
from .queries_relational import ATTACH_SQL, POSTS_SQL, _hist_sql, _posts_out


def _post_messages(spark, sf):
    return fx.posts(spark, sf).withColumn("dt", F.col("dt").cast("string"))


def _dirs(spark, name):
    base = scratch_path(spark, name)
    return {k: os.path.join(base, k) for k in ("in", "in2", "out", "ckpt", "dead")}


@register("stream_ingest", POSTS_SQL.format(src="posts"))
def stream_ingest(spark, sf):
    d = _dirs(spark, "ingest")
    ingest.write_messages(_post_messages(spark, sf), d["in"])
    s = ingest.read_messages(spark, d["in"], POST_MESSAGE_SCHEMA)
    ingest.run_to_table(s, d["out"], d["ckpt"])
    return _posts_out(spark.read.parquet(d["out"]))


@register("stream_dedup", "SELECT doc_id, CAST(dt AS VARCHAR) AS dt FROM posts")
def stream_dedup(spark, sf):
    """Every message delivered twice; each id comes out once."""
    d = _dirs(spark, "dedup")
    msgs = _post_messages(spark, sf)
    ingest.write_messages(msgs, d["in"])
    ingest.write_messages(msgs, d["in"])           # replayed delivery
    s = ingest.with_event_time(ingest.read_messages(spark, d["in"], POST_MESSAGE_SCHEMA))
    ingest.run_to_table(ingest.dedup_stream(s, "doc_id", "event_ts", "60 days").select("doc_id", "dt"),
                        d["out"], d["ckpt"], fail_on_dropped=True)
    return spark.read.parquet(d["out"])


@register("stream_kpis", "SELECT symbol, count(*) AS n_posts, round(sum(volume), 4) AS sum_volume FROM posts GROUP BY symbol")
def stream_kpis(spark, sf):
    d = _dirs(spark, "kpis")
    ingest.write_messages(_post_messages(spark, sf), d["in"])
    s = ingest.read_messages(spark, d["in"], POST_MESSAGE_SCHEMA)
    ingest.run_foreach_batch(kpis.symbol_totals(s), kpis.write_by_batch(d["out"]), d["ckpt"], "complete")
    return kpis.read_newest(spark, d["out"]).withColumn("sum_volume", F.round("sum_volume", 4))


@register("stream_correlate", ATTACH_SQL + "SELECT doc_id, prediction, sentiment FROM attached")
def stream_correlate(spark, sf):
    return _correlated(spark, sf).select("doc_id", "prediction", "sentiment")


@register("live_histograms", _hist_sql())
def live_histograms(spark, sf):
    """D13 over the live table (the live view's five histograms)."""
    h = live.live_histograms(_correlated(spark, sf))
    return h.withColumn("bin_start", F.round("bin_start", 6))


@register("live_latest", ATTACH_SQL + """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol, close, prediction, sentiment FROM attached ORDER BY dt DESC, doc_id DESC LIMIT 10""")
def live_latest(spark, sf):
    """E4 over the live table (the live view's latest ten rows)."""
    return live.live_latest(_correlated(spark, sf)).select("doc_id", "dt", "symbol", "close", "prediction", "sentiment")


@register("stream_live_kpis", ATTACH_SQL + """
SELECT count(*) AS n_posts, count(prediction) AS n_scored,
       round(coalesce(avg(prediction), 0.0), 6) AS mean_prediction,
       CAST(count_if(sentiment = 'Positive') AS BIGINT) AS n_positive,
       CAST(count_if(sentiment = 'Negative') AS BIGINT) AS n_negative,
       CAST(count_if(sentiment = 'Neutral') AS BIGINT) AS n_neutral FROM attached""")
def stream_live_kpis(spark, sf):
    """Totals, scored posts, mean prediction and label counts of the live table."""
    from ..operators.stats import live_kpis
    k = live_kpis(_correlated(spark, sf), with_labels=True)
    return k.withColumn("mean_prediction", F.round("mean_prediction", 6))


def _correlated(spark, sf):
    """I4: post stream LEFT OUTER JOIN prediction stream; a far-future marker on both sides
    (written last) moves the watermarks past all data so unmatched posts are emitted."""
    d = _dirs(spark, "correlate")
    posts = _post_messages(spark, sf)
    preds = fx.predictions(spark, sf).withColumn("dt", F.col("dt").cast("string"))
    ingest.write_messages(posts, d["in"], compression="gzip")
    ingest.write_messages(preds, d["in2"], compression="gzip")
    marker_post = posts.limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit("2100-01-01").alias("dt"),
                                        *[F.col(c) for c in posts.columns if c not in ("doc_id", "dt")])
    marker_pred = preds.limit(1).select(F.lit(-1).cast("long").alias("seq"), F.lit("2100-01-01").alias("dt"),
                                        "tweet", "prediction", "close")
    # messages of both streams arrive in any order within the delay
    ingest.write_messages(marker_post, d["in"])
    ingest.write_messages(marker_pred, d["in2"])
    ps = ingest.read_messages(spark, d["in"], POST_MESSAGE_SCHEMA)
    qs = ingest.read_messages(spark, d["in2"], PREDICTION_MESSAGE_SCHEMA)
    joined = correlate.correlate_streams(ps, qs, delay="60 days")
    ingest.run_to_table(joined, d["out"], d["ckpt"], fail_on_dropped=True)
    matches = spark.read.parquet(d["out"]).filter(F.col("doc_id") >= 0)
    return correlate.latest_state(matches)


def _live_log(spark, sf):
    """The live view's log of versions: the posts first, then the predictions, two runs of one streaming query."""
    d = _dirs(spark, "live-view")
    posts, preds = _post_messages(spark, sf), fx.predictions(spark, sf).withColumn("dt", F.col("dt").cast("string"))
    ingest.write_messages(posts, d["in"])
    ingest.write_messages(preds.limit(0), d["in2"])
    for late in (None, preds):
        if late is not None:
            ingest.write_messages(late, d["in2"])
        log = liveview.live_versions(ingest.read_messages(spark, d["in"], POST_MESSAGE_SCHEMA),
                                     ingest.read_messages(spark, d["in2"], PREDICTION_MESSAGE_SCHEMA))
        ingest.run_to_table(log, d["out"], d["ckpt"], fail_on_dropped=True, keyed_state=True)
    return d["out"]


@register("stream_live_view", ATTACH_SQL + """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol, close, prediction, sentiment FROM attached""")
def stream_live_view(spark, sf):
    """I4/I5 by keyed state: every post shown on arrival, and again with its last prediction."""
    return liveview.live_rows(spark, _live_log(spark, sf)).select("doc_id", "dt", "symbol", "close", "prediction", "sentiment")


@register("stream_live_versions", ATTACH_SQL + """
SELECT CASE WHEN prediction IS NULL THEN 1 ELSE 2 END AS versions, CAST(count(*) AS BIGINT) AS n_posts FROM attached GROUP BY 1""")
def stream_live_versions(spark, sf):
    """I4: how often posts were shown: once unscored, once more when the prediction came."""
    log = spark.read.schema(liveview.VIEW_SCHEMA).parquet(_live_log(spark, sf))
    return log.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("versions")) \
        .groupBy("versions").agg(F.count(F.lit(1)).alias("n_posts"))


_DIST_METRICS = ("low", "high", "open", "close", "volume")


def _running_state(spark, sf):
    """The attached posts as a stream, in several micro-batches; the newest state of the running distributions."""
    d = _dirs(spark, "distributions")
    rows = joins.attach_predictions(fx.posts(spark, sf), fx.predictions(spark, sf)).drop("tweet").withColumn("dt", F.col("dt").cast("string"))
    rows.repartition(4).write.parquet(d["in"])
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(d["in"])
    ingest.run_foreach_batch(distributions.running_state(s), kpis.write_by_batch(d["out"]), d["ckpt"], "complete")
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(d["in"])
    ingest.run_foreach_batch(s, distributions.write_latest(d["dead"]), d["ckpt"] + "-latest")
    return kpis.read_newest(spark, d["out"]), kpis.read_newest(spark, d["dead"])


@register("stream_distributions", ATTACH_SQL + "\nUNION ALL ".join(f"""
SELECT '{c}' AS metric, CAST(count({c}) AS BIGINT) AS n, min({c}) AS lo, max({c}) AS hi, round(avg({c}), 6) AS mean, true AS quartiles_close,
       CAST(count_if(sentiment = 'Positive') AS BIGINT) AS n_positive, CAST(count_if(sentiment = 'Negative') AS BIGINT) AS n_negative FROM attached"""
                                                                  for c in _DIST_METRICS))
def stream_distributions(spark, sf):
    """Counts, extremes, means and label counts of the running state are exact; the ranks of its quartiles among all rows
    are within the sketch's error."""
    state, _ = _running_state(spark, sf)
    told = sketches.describe_sketches(state, _DIST_METRICS)
    exact = sketches.rank_errors(fx.posts(spark, sf), told, _DIST_METRICS)
    labels = state.select("n_positive", "n_negative")
    return (told.join(exact, "metric").join(F.broadcast(labels))
            .select("metric", "n", "lo", "hi", F.round("mean", 6).alias("mean"), (F.col("rank_error") <= sketches.RANK_ERROR).alias("quartiles_close"),
                    "n_positive", "n_negative"))


@register("stream_latest", ATTACH_SQL + """
SELECT doc_id, CAST(dt AS VARCHAR) AS dt, symbol, close, prediction, sentiment FROM attached ORDER BY dt DESC, doc_id DESC LIMIT 10""")
def stream_latest(spark, sf):
    """E4 per micro-batch: the ten latest rows of the stream so far."""
    return _running_state(spark, sf)[1].select("doc_id", "dt", "symbol", "close", "prediction", "sentiment")


_DEAD_SQL = r"""
, msg AS (SELECT doc_id, tweet, close, open, high, low, volume, (doc_id % 23 = 0) AS broken FROM posts_dirty)
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN broken THEN 'bad_json'
              WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL THEN 'null_numeric'
              WHEN coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(tweet),
                   ':[a-z_]+:', '', 'g'), 'http\S+|www\S+|https\S+', '', 'g'), '@\w+|#\w+', '', 'g'),
                   '[^\w\s$%]', '', 'g'), '') = '' THEN 'empty_text'
              ELSE 'ok' END AS reason FROM msg) GROUP BY reason"""


def _dirty_messages(spark, sf):
    """Messages of the dirty posts; those with doc_id % 23 = 0 arrive truncated (bad JSON)."""
    enc = encode_json(fx.posts_dirty(spark, sf), drop=())
    enc = enc.withColumn("doc_id", F.get_json_object("value", "$.doc_id").cast("long"))
    broken = F.col("doc_id") % 23 == 0
    return enc.select(F.when(broken, F.expr("substring(value, 1, length(value) - 7)")).otherwise(F.col("value")).alias("value"))


@register("dead_letter", _DEAD_SQL)
def dead_letter(spark, sf):
    """I8 batch twin: classify every message; counts per route."""
    c = deadletter.classify_messages(_dirty_messages(spark, sf), POST_MESSAGE_SCHEMA)
    return c.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("dead_letter_stream", _DEAD_SQL)
def dead_letter_stream(spark, sf):
    """I8 as a stream: foreachBatch splits each micro-batch into good rows and dead letters."""
    d = _dirs(spark, "deadletter")
    _dirty_messages(spark, sf).write.mode("append").text(d["in"])
    raw = ingest.read_raw(spark, d["in"])
    c = deadletter.classify_messages(raw, POST_MESSAGE_SCHEMA)
    ingest.run_foreach_batch(c, lambda b, i: deadletter.split_batch(b, d["out"], d["dead"], i), d["ckpt"])
    ok = spark.read.parquet(d["out"]).select("reason")
    dead = spark.read.parquet(d["dead"]).select("reason")
    return ok.unionByName(dead).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _train_posts(spark, sf):
    return ft.hash_split(fx.posts(spark, sf)).filter(F.col("part") == "train")


def _saved_model(spark, sf, name):
    """The full pipeline, fitted on the training posts, saved and loaded again."""
    model = pp.fit_full_model(_train_posts(spark, sf))
    saved = pp.load_model(pp.save_model(model, scratch_path(spark, name)))
    pp.drop_vectors(spark, model)
    return saved


def finite(c="prediction"):
    """Whether a number is there, not NaN and not infinite."""
    c = F.col(c)
    return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


@register("stream_score", "SELECT doc_id, close, true AS finite FROM clean_posts WHERE clean_tweet <> ''")
def stream_score(spark, sf):
    """The saved full pipeline scores the post stream micro-batch by micro-batch."""
    d = _dirs(spark, "score")
    model = _saved_model(spark, sf, "stream-model")
    ingest.write_messages(_post_messages(spark, sf), d["in"], compression="gzip")
    score.score_messages(ingest.read_raw(spark, d["in"]), model, d["out"], d["dead"], d["ckpt"])
    out = kpis.read_committed(spark, d["out"], PREDICTION_MESSAGE_SCHEMA)
    return out.select("doc_id", "close", finite().alias("finite"))


@register("prediction_message", POSTS_SQL.format(src="clean_posts").replace(
    "adj_close, volume FROM", "adj_close, volume, doc_id AS seq, true AS finite FROM") + " WHERE clean_tweet <> ''")
def prediction_message(spark, sf):
    """A prediction message carries the whole post message."""
    d = _dirs(spark, "message")
    ingest.write_messages(_post_messages(spark, sf), d["in"], compression="gzip")
    score.score_messages(ingest.read_raw(spark, d["in"]), _saved_model(spark, sf, "message-model"), d["out"], d["dead"], d["ckpt"])
    out = kpis.read_committed(spark, d["out"], PREDICTION_MESSAGE_SCHEMA)
    return out.select("doc_id", "dt", "tweet", "symbol", "open", "high", "low", "close", "adj_close", "volume", "seq",
                      finite().alias("finite"))


@register("stream_score_dirty", _DEAD_SQL)
def stream_score_dirty(spark, sf):
    """I2 + I8: scored messages and dead letters of a dirty stream, counted by route."""
    d = _dirs(spark, "score-dirty")
    _dirty_messages(spark, sf).write.mode("append").option("compression", "gzip").text(d["in"])
    score.score_messages(ingest.read_raw(spark, d["in"]), _saved_model(spark, sf, "dirty-model"), d["out"], d["dead"], d["ckpt"])
    ok = kpis.read_committed(spark, d["out"], PREDICTION_MESSAGE_SCHEMA).filter(finite()).select(F.lit("ok").alias("reason"))
    dead = spark.read.parquet(d["dead"] + "/*").select("reason")
    return ok.unionByName(dead).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("stream_live", "SELECT count(*) AS n_posts, count(*) AS n_scored FROM clean_posts WHERE clean_tweet <> ''")
def stream_live(spark, sf):
    """I2 -> I4 -> I6: score the post stream with the saved pipeline, correlate the
    resulting prediction stream with the post stream, report live totals of the end state.
    A far-future marker post (written last) moves the watermarks past all data."""
    d = _dirs(spark, "live")
    posts = _post_messages(spark, sf)
    ingest.write_messages(posts, d["in"], compression="gzip")
    marker = posts.limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit("2100-01-01").alias("dt"),
                                   *[F.col(c) for c in posts.columns if c not in ("doc_id", "dt")])
    ingest.write_messages(marker, d["in"])
    path = live.run_live(spark, d["in"], _saved_model(spark, sf, "live-model"), d["out"])
    return live.live_totals(spark, path).select("n_posts", "n_scored")
