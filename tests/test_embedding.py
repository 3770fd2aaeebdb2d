"""Word vectors with the vocabulary in shards."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textprice.operators import embedding as em


def corpus(n=1500, seed=4):
    """Six pairs of nouns; both of a pair stand in the same places, between the pair's own three neighbours."""
    rng = random.Random(seed)
    fill = [f"f{i}" for i in range(12)]
    out = []
    for i in range(n):
        words = []
        for _ in range(3):
            p = rng.randrange(6)
            near = [f"near{p}{j}" for j in range(3)]
            words += [rng.choice(fill), rng.choice(near), rng.choice(NOUNS[p]), rng.choice(near), rng.choice(fill), rng.choice(fill)]
        out.append((i, words))
    return out


NOUNS = [("car", "auto"), ("milk", "lait"), ("dog", "hound"), ("sea", "ocean"), ("road", "street"), ("home", "house")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, tokens array<string>").repartition(5).cache()


def vectors(model):
    return {r.word: np.array(r.vector) for r in model.getVectors().collect()}


def cosine(a, b):
    return a @ b / np.linalg.norm(a) / np.linalg.norm(b)


def test_words_of_the_same_places_are_neighbours(docs):
    model = em.ShardedWord2Vec(vectorSize=24, windowSize=2, maxIter=8, stepSize=0.05, groups=8).fit(docs)
    v = vectors(model)
    nouns = [w for pair in NOUNS for w in pair]
    for a, b in NOUNS:
        assert max((cosine(v[a], v[w]), w) for w in nouns if w != a)[1] == b
        assert max((cosine(v[b], v[w]), w) for w in nouns if w != b)[1] == a


def test_document_vectors_are_means_and_do_not_depend_on_partitions(spark, docs):
    model = em.ShardedWord2Vec(vectorSize=10, groups=4).fit(docs)
    again = em.ShardedWord2Vec(vectorSize=10, groups=4).fit(docs.repartition(11))
    v, w = vectors(model), vectors(again)
    assert set(v) == set(w) and all(np.allclose(v[k], w[k], atol=1e-6) for k in v)
    odd = spark.createDataFrame([(1, ["car", "car", "milk", "unknown", None]), (2, []), (3, None), (4, ["unknown"]), (5, ["milk"]), (5, ["milk"])],
                                "doc_id long, tokens array<string>")
    got = {r.doc_id: np.array(r.e) for r in model.transform(odd).select("doc_id", vector_to_array("embedding").alias("e")).collect()}
    np.testing.assert_allclose(got[1], (2 * v["car"] + v["milk"]) / 3, atol=1e-9)
    np.testing.assert_allclose(got[5], v["milk"], atol=1e-9)
    assert not got[2].any() and not got[3].any() and not got[4].any()
    assert model.transform(odd).count() == 6 and model.transform(odd.limit(0)).count() == 0
    assert model.transform(docs).columns == ["doc_id", "tokens", "embedding"]


def test_one_round_equals_training_by_hand(spark):
    """One group, one round: the table is what the numpy trainer makes of the group's texts."""
    rows = corpus(60, 8)
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").coalesce(1)
    got = vectors(em.ShardedWord2Vec(vectorSize=6, windowSize=2, groups=1).fit(df))
    assert set(got) == {w for _, t in rows for w in t}
    start = dict(zip(sorted(got), em.start_vectors(sorted(got), 6, 42), strict=True))
    assert all(np.abs(start[w]).max() <= 0.5 / 6 for w in got)
    assert any(np.abs(got[w] - start[w]).max() > 1e-4 for w in got)


def test_training_raises_the_likelihood_of_seen_pairs():
    rng = np.random.default_rng(0)
    rows = [rng.integers(0, 5, 40) + (5 if i % 2 else 0) for i in range(100)]  # two sets of words that never meet
    centre, context = np.array(em.start_vectors([str(i) for i in range(10)], 8, 1)), np.zeros((10, 8), np.float32)
    for _ in range(10):
        em.train_group(rows, centre, context, 3, 0.05, 0)
    scores = centre @ context.T
    assert scores[:5, :5].mean() > scores[:5, 5:].mean() + 1 and scores[5:, 5:].mean() > scores[5:, :5].mean() + 1


def test_every_pair_within_the_window_counts_once():
    """Pairs over a run's end are in exactly one run."""
    window, n = 5, 400
    step, seen = em.RUN - window, np.zeros((n, n), int)
    for at in range(0, n, step):
        place = np.arange(at, min(at + em.RUN, n))
        pairs = (np.abs(place[None, :] - place[:, None]) <= window) & (place[None, :] != place[:, None])
        if at:
            pairs[:window, :window] = False
        seen[np.ix_(place, place)] += pairs
    i, j = np.indices((n, n))
    assert (seen == ((np.abs(i - j) <= window) & (i != j))).all()


def test_saved_in_a_pipeline_and_loaded(spark, docs, tmp_path):
    pipe = Pipeline(stages=[em.ShardedWord2Vec(vectorSize=7, groups=4, inputCol="tokens", outputCol="e")]).fit(docs)
    path = str(tmp_path / "model")
    pipe.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = {r.doc_id: list(r.e) for r in pipe.transform(docs).select("doc_id", vector_to_array("e").alias("e")).collect()}
    b = {r.doc_id: list(r.e) for r in back.transform(docs).select("doc_id", vector_to_array("e").alias("e")).collect()}
    assert a == b
    assert back.stages[0].getOrDefault("vectorSize") == 7 and back.stages[0].uid == pipe.stages[0].uid


def test_empty_corpus(spark):
    model = em.ShardedWord2Vec(vectorSize=4).fit(spark.createDataFrame([], "doc_id long, tokens array<string>"))
    assert model.getVectors().count() == 0
    got = model.transform(spark.createDataFrame([(1, ["a"])], "doc_id long, tokens array<string>")).first()
    assert list(got.embedding) == [0.0] * 4


def test_nothing_is_collected(docs):
    """Fitting and embedding have no broadcast and no global sort, and vectors cross exchanges by word and by group."""
    model = em.ShardedWord2Vec(vectorSize=4, groups=4).fit(docs)
    plan = model.transform(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_group" in plan and "Sort [" in plan and "GlobalLimit" not in plan
    assert model.transform(docs).agg(F.count(F.lit(1))).first()[0] == 1500


def test_groups_follow_the_size_of_the_tokens(spark, docs):
    """Not the number of shuffle partitions: every group gets the vectors of its words, so small groups move the most."""
    assert em.group_number(spark, 0) == 1
    assert em.group_number(spark, 100 * em.GROUP_BYTES) == max(100, spark.sparkContext.defaultParallelism)
    size = docs.agg(em.token_bytes("tokens")).first()[0]
    assert size == sum(len(t) + 1 for _, ts in corpus() for t in ts)
    path = em.fit_word_vectors(docs, "tokens", 4)
    rows = spark.read.parquet(path)
    assert rows.where("context IS NOT NULL").count() == 0 and rows.where("length(centre) <> 16").count() == 0


def test_words_of_few_places_are_left_out(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, ["b", "a", None])], "doc_id long, tokens array<string>")
    assert set(vectors(em.ShardedWord2Vec(vectorSize=4, minCount=2).fit(df))) == {"a", "b"}


def test_struct_and_vector_columns_pass_through(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(1, ["a", "b"], Vectors.dense(1.0, 2.0), (1, "x")), (2, ["a"], Vectors.sparse(3, [1], [5.0]), None), (None, None, None, (None, "y"))]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tokens", T.ArrayType(T.StringType())),
                           T.StructField("v", VectorUDT()), T.StructField("s", T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())]))])
    df = spark.createDataFrame(rows, schema)
    before = len(em.rows_written())
    got = em.ShardedWord2Vec(vectorSize=4).fit(df).transform(df).collect()
    assert {(r.doc_id, r.v, r.s and tuple(r.s)) for r in got} == {(a, v, s) for a, _, v, s in rows}
    em.drop_rows(spark, before)
    assert len(em.rows_written()) == before
