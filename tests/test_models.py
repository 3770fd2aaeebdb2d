"""Rows-only ML queries: finite values and seeded repeatability on one partition."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textprice.operators import features as ft
from textprice.operators import models
from textprice.plans import preprocessing as pp
from textprice.sources import fixtures as fx


@pytest.mark.parametrize("embedding", ["word2vec", "hashed"])
def test_full_model_is_repeatable_and_finite(spark, embedding):
    p = ft.hash_split(fx.posts(spark, SF_SMALL)).coalesce(1)
    train, test = p.filter(F.col("part") == "train"), p.filter(F.col("part") == "test")
    runs = []
    for _ in range(2):
        m = pp.fit_full_model(train, vector_size=16, num_partitions=1, seed=7, embedding=embedding)
        runs.append({r.doc_id: r.prediction for r in pp.score(test, m).collect()})
    assert runs[0].keys() == runs[1].keys() and len(runs[0]) > 0
    assert all(math.isfinite(v) for v in runs[0].values())
    assert all(abs(runs[0][k] - runs[1][k]) < 1e-9 for k in runs[0])


def test_feature_width_is_embedding_plus_four(spark):
    p = fx.posts(spark, SF_SMALL)
    m = pp.fit_preprocessing(p, vector_size=12, num_partitions=1)
    row = models.feature_width(m.transform(p)).first()
    assert row.min_width == row.max_width == 16 and row.n_rows == 200


def test_regression_metrics_perfect_and_mean_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "y double, p double")
    r = models.regression_metrics(df, "y", "p").first()
    assert r.rmse == 0.0 and r.r2 == 1.0
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    assert abs(models.regression_metrics(df2, "y", "p").first().r2) < 1e-12


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("b", 1.0, 1.0), ("b", 3.0, 3.0)], "k string, y double, p double")
    got = {r.k: r.r2 for r in models.regression_metrics(df, "y", "p", ["k"]).collect()}
    assert got == {"a": None, "b": 1.0}


def test_null_rows_neither_train_nor_kill_scoring(spark):
    p = fx.posts_dirty(spark, SF_SMALL)
    m = pp.fit_full_model(p, vector_size=8, embedding="hashed")
    holes = p.withColumn("open", F.when(F.col("doc_id") % 2 == 0, F.col("open")))
    scored = pp.score(holes, m)
    assert scored.filter(F.col("doc_id") % 2 == 1).count() == 0
    assert scored.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0 and scored.count() > 0
    assert set(p.columns) < set(scored.columns)


def test_fitting_leaves_nothing_cached_and_a_missing_model_raises(spark):
    import os
    spark.catalog.clearCache()
    pp.fit_full_model(fx.posts(spark, SF_SMALL), vector_size=8, embedding="hashed")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    with pytest.raises(Exception, match="(?i)does not exist|not found|Input path"):
        pp.load_model(os.path.join("/tmp", "no-such-model"))


def test_trees_are_compared_in_few_partitions_and_all_folds_at_once(spark):
    import threading

    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import DecisionTreeRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    rows = [(Vectors.dense([i % 7, i % 11]), float(i % 7 + (i % 11) ** 2), i % 5) for i in range(300)]
    train = spark.createDataFrame(rows, ["features", "close", "fold"]).withColumn("fold", F.col("fold").cast("int")).repartition(12)
    seen, together = [], threading.Barrier(5)

    class Tree(DecisionTreeRegressor):
        def fit(self, dataset, params=None):
            seen.append(dataset.rdd.getNumPartitions())
            if len(seen) <= 5:
                together.wait(60)  # breaks if folds are fitted one after another
            return super().fit(dataset, params)

    est = Tree(labelCol="close", seed=42)
    grid = ParamGridBuilder().addGrid(est.maxDepth, [3]).build()
    got = models.compare_models(train, train, models=[("Tree", est, grid)], parallelism=5).first()
    assert seen == [1] * 6 and not train.is_cached
    plain = DecisionTreeRegressor(labelCol="close", seed=42)
    cv = CrossValidator(estimator=plain, estimatorParamMaps=ParamGridBuilder().addGrid(plain.maxDepth, [3]).build(), numFolds=5,
                        foldCol="fold", evaluator=RegressionEvaluator(labelCol="close"))
    assert abs(got.avg_rmse - cv.fit(train.coalesce(1)).avgMetrics[0]) < 1e-9
    with pytest.raises(ValueError, match="fold"):
        models.compare_models(train.where("fold <> 2"), train, models=[("Tree", est, grid)])
