"""Models and evaluation."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def regression_metrics(df: DataFrame, label: str, prediction: str, by=()) -> DataFrame:
    """RMSE and R² in one aggregate (R² = 1 - SSE / (n * population variance))."""
    err = F.col(label) - F.col(prediction)
    g = df.groupBy(*by) if by else df
    return g.agg(F.count(F.lit(1)).alias("n"),
                 F.sqrt(F.avg(err * err)).alias("rmse"),
                 # null for a constant label, whose variance is 0
                 (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(label) * F.count(F.lit(1)))).alias("r2"))


def linear_regression(features: str = "features", label: str = "close") -> LinearRegression:
    """No regularisation, with intercept, solver auto (normal equations for few features)."""
    return LinearRegression(featuresCol=features, labelCol=label)


def candidate_models(features: str = "features", label: str = "close", seed: int = 42):
    """The four compared regressors and their grids (depth 5 and 10 for trees)."""
    lr = LinearRegression(featuresCol=features, labelCol=label)
    dt = DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=seed)
    rf = RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed)
    gbt = GBTRegressor(featuresCol=features, labelCol=label, seed=seed)
    grid = lambda m: ParamGridBuilder().addGrid(m.maxDepth, [5, 10]).build()
    return [("Linear Regression", lr, ParamGridBuilder().build()),
            ("Decision Tree Regression", dt, grid(dt)),
            ("Random Forest Regression", rf, grid(rf)),
            ("Gradient Boosted Tree Regression", gbt, grid(gbt))]


def fold_sums(df: DataFrame, features: str = "features", label: str = "close", fold: str = "fold") -> DataFrame:
    """(fold, i, j, v): for every fold the sums of products of columns i >= j of (1, features, label): tasks add up
    their rows' in matrices, Spark adds up the tasks'.  All linear fits and errors of cross-validation follow from these,
    whose number depends on the features only.  Rows with a null are left out."""
    from pyspark.ml.functions import vector_to_array
    rows = df.where(F.col(fold).isNotNull() & F.col(features).isNotNull() & F.col(label).isNotNull()) \
        .select(F.col(fold).cast("int"), F.col(label).cast("double"), vector_to_array(features))

    def add(batches):
        import numpy as np
        import pyarrow as pa
        sums: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            folds, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            z = np.column_stack((np.ones(len(y)), b.column(2).flatten().to_numpy().reshape(len(y), -1), y))
            for f in np.unique(folds):
                part = z[folds == f]
                sums[int(f)] = sums.get(int(f), 0) + part.T @ part
        for f, s in sums.items():
            i, j = np.tril_indices(len(s))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), f), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(s[i, j])], names=["fold", "i", "j", "v"])

    return rows.mapInArrow(add, "fold int, i int, j int, v double").groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))


def fit_from_sums(s):
    """The least squares fit to the rows with sums of products ``s``: its coefficients, of 1 and the features, and a function
    that gives its sum of squared errors on rows with sums ``t``."""
    import numpy as np
    scale = np.sqrt(np.diag(s)[:-1])
    scale[scale == 0] = 1.0
    xx, xy = s[:-1, :-1] / scale / scale[:, None], s[:-1, -1] / scale
    beta = np.linalg.lstsq(xx, xy, rcond=1e-13)[0] / scale
    weights = np.append(-beta, 1.0)  # error of a row: its columns times these
    return beta, lambda t: max(float(weights @ t @ weights), 0.0)


def linear_cross_validation(df: DataFrame, features: str = "features", label: str = "close", fold: str = "fold") -> DataFrame:
    """G12 for least squares: (fold, n, rmse): each fold's error under the fit on the other folds, which is got by
    subtraction.  One job, whatever the number of folds; the driver sees folds x features² numbers."""
    import numpy as np
    spark = df.sparkSession
    cells = fold_sums(df, features, label, fold).collect()
    size = 1 + max((r["i"] for r in cells), default=-1)
    folds: dict = {}
    for r in cells:
        m = folds.setdefault(r["fold"], np.zeros((size, size)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    whole = sum(folds.values()) if folds else None
    rows = []
    for f, s in sorted(folds.items()):
        n, rest = int(round(s[0, 0])), whole - s
        error = fit_from_sums(rest)[1] if rest[0, 0] > 0.5 else None  # no fit without another fold
        rows.append((f, n, float(np.sqrt(error(s) / n)) if error else None))
    return spark.createDataFrame(rows, "fold int, n long, rmse double")


ROWS_PER_TASK = 1 << 16  # of the compared models' jobs: some 55 MB of 104 features, 27 MB when binned for trees


def check_folds(sizes: dict, num_folds: int) -> None:
    """``sizes`` (rows by fold) must have all folds and no others."""
    odd = [f for f in sizes if f is None or not 0 <= f < num_folds]
    if odd:
        raise ValueError(f"fold numbers must be in [0, {num_folds}), but there is {odd[0]}")
    for f in range(num_folds):
        if not sizes.get(f):
            raise ValueError(f"the validation data of fold {f} is empty")


def cross_validation(train: DataFrame, est, grid, evaluator, fold_col: str, num_folds: int, pool):
    """Each grid point's error, averaged over the folds.  All folds' and grid points' fits are submitted to ``pool`` at
    once: a tree's levels are jobs that wait for one another, so one fold after another would leave the cluster idle."""
    import numpy as np

    def error(params, fold):
        model = est.fit(train.where(F.col(fold_col) != fold), params)
        return evaluator.evaluate(model.transform(train.where(F.col(fold_col) == fold)))

    runs = [[pool.submit(error, params, f) for f in range(num_folds)] for params in grid]
    return np.array([np.mean([r.result() for r in row]) for row in runs], dtype=float)


MODEL_COMPARE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("avg_rmse", T.DoubleType()),
    T.StructField("std_rmse", T.DoubleType()), T.StructField("max_rmse", T.DoubleType()),
    T.StructField("min_rmse", T.DoubleType()), T.StructField("train_r2", T.DoubleType()),
    T.StructField("test_rmse", T.DoubleType()), T.StructField("test_r2", T.DoubleType()),
    T.StructField("n_points", T.IntegerType())])


def compare_models(train: DataFrame, test: DataFrame, features: str = "features", label: str = "close",
                   fold_col: str = "fold", num_folds: int = 5, parallelism: int | None = None, seed: int = 42,
                   models=None) -> DataFrame:
    """K-fold cross-validation per model on stable folds; statistics over the grid
    points' fold-averaged RMSE (mean, population std, max, min), R² of the best model on the
    training rows (as the reference reports) and, in addition, RMSE/R² on the held-out rows.
    The fitting is Spark ML (distributed); only the per-model summary numbers are local."""
    from concurrent.futures import ThreadPoolExecutor

    import numpy as np
    spark = train.sparkSession
    parallelism = parallelism or spark.sparkContext.defaultParallelism
    rmse_eval = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    r2_eval = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")

    def evaluate(item):
        name, est, grid = item
        plain = isinstance(est, LinearRegression) and len(grid) == 1 and est.getRegParam() == 0 and est.getFitIntercept()
        if plain:  # every fold's fit from one pass
            folds = [r["rmse"] for r in linear_cross_validation(few, features, label, fold_col).collect()]
            return summary(name, est.fit(few), np.array([np.mean(folds)]), grid)
        check_folds(sizes, num_folds)
        metric = cross_validation(few, est, grid, rmse_eval, fold_col, num_folds, fits)
        return summary(name, est.fit(few, grid[int(metric.argmin())]), metric, grid)

    def summary(name, best, metric, grid):
        tr, te = best.transform(few), best.transform(test)
        return (name, float(metric.mean()), float(metric.std()), float(metric.max()),
                float(metric.min()), float(r2_eval.evaluate(tr)), float(rmse_eval.evaluate(te)),
                float(r2_eval.evaluate(te)), len(grid))

    own = not train.is_cached
    if own:
        train = train.persist()
    try:
        sizes = {r[fold_col]: r["count"] for r in train.groupBy(fold_col).count().collect()}  # a row per fold
        # Trees are grown by some thousand short jobs over all partitions.  The cached rows are read in as few
        # partitions as their number needs, not in as many as made them.
        few = train.coalesce(max(1, -(-sum(sizes.values()) // ROWS_PER_TASK)))
        # The models' cross-validations are independent: their (many, small) Spark jobs are
        # submitted from concurrent driver threads so the cluster is not idle between them.
        candidates = list(models or candidate_models(features, label, seed))
        with ThreadPoolExecutor(max_workers=parallelism) as fits, ThreadPoolExecutor(max_workers=len(candidates)) as pool:
            rows = list(pool.map(evaluate, candidates))
    finally:
        if own:
            train.unpersist()
    return spark.createDataFrame(rows, MODEL_COMPARE_SCHEMA).orderBy("avg_rmse")


def feature_width(df: DataFrame, col: str = "features") -> DataFrame:
    """min/max length of the feature vectors."""
    from pyspark.ml.functions import vector_to_array
    n = F.size(vector_to_array(col))
    return df.agg(F.min(n).alias("min_width"), F.max(n).alias("max_width"), F.count(F.lit(1)).alias("n_rows"))
