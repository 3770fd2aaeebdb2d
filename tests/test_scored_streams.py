"""Scored streams: what is written and kept."""

import glob
import os

from tests.test_scoring_at_size import posts, scratch  # noqa: F401
from textprice.operators import embedding as em
from textprice.plans import preprocessing as pp
from textprice.session import scratch_path
from textprice.streaming import ingest, kpis, score


def test_scored_messages_are_compressed_and_batches_not_kept(spark, posts):
    base, model = scratch_path(spark, "scored-test"), pp.fit_full_model(posts, vector_size=4)
    before, cached = (scratch(spark, "scored-batch"), scratch(spark, "rows-to-embed")), spark.sparkContext._jsc.getPersistentRDDs().size()
    ingest.write_messages(posts, f"{base}/in", compression="gzip")
    score.score_messages(ingest.read_raw(spark, f"{base}/in"), model, f"{base}/out", f"{base}/dead", f"{base}/ck")
    files = glob.glob(f"{base.removeprefix('file:')}/out/batch-*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    rows = kpis.read_committed(spark, f"{base}/out", score.PREDICTION_MESSAGE_SCHEMA)
    assert rows.count() == 392 and rows.where("prediction IS NULL").count() == 0
    assert spark.read.parquet(f"{base}/dead/*").count() == 8
    assert (scratch(spark, "scored-batch"), scratch(spark, "rows-to-embed")) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_saved_models_vectors_are_kept_once(spark, posts):
    model = pp.fit_full_model(posts, vector_size=4)
    saved = pp.load_model(pp.save_model(model, scratch_path(spark, "model-test")))
    path = next(s.path for s in model.stages if isinstance(s, em.ShardedWord2VecModel)).removeprefix("file:")
    assert os.path.isdir(path)
    pp.drop_vectors(spark, model)
    assert not os.path.isdir(path) and pp.score(posts, saved).count() == 400
