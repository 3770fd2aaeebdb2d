"""Preprocessing and model pipelines.

The cleaner and the column selector are ``SQLTransformer`` stages, so the whole fitted
pipeline — cleaning included — saves and loads with Spark ML's own writer; nothing has to be
stripped before saving."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, SQLTransformer, StopWordsRemover, Tokenizer
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.embedding import ShardedWord2Vec, ShardedWord2VecModel, drop_rows, rows_written
from ..operators.features import assemble
from ..operators.textops import hashed_embedding, word2vec
from ..session import delete, exchanges_dropped, stored

NUMERIC_INPUTS = ["open", "high", "low", "volume"]
TARGET = "close"


def cleaner_stage(input_col: str = "tweet", output_col: str = "clean_tweet") -> SQLTransformer:
    """The composed cleaner as a persistable stage; rows cleaned to '' are dropped."""
    # The drop is fused into a 0-or-1-row generator so the cleaner is evaluated once per row.
    return SQLTransformer(statement=(
        f"SELECT * FROM __THIS__ LATERAL VIEW explode(array_remove(array(coalesce("
        f"{tx.clean_sql(input_col)}, '')), '')) kept AS {output_col}"))


def selector_stage(cols) -> SQLTransformer:
    return SQLTransformer(statement="SELECT " + ", ".join(cols) + " FROM __THIS__")


def null_drop_stage(cols) -> SQLTransformer:
    """Rows that lack an input are dropped (B2), in training and in scoring."""
    return SQLTransformer(statement="SELECT * FROM __THIS__ WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols))


TEXT_STAGES = 5   # the first stages need no fitting: null drop, cleaner, tokens, stop words, no other texts


def preprocessing_stages(vector_size: int = 100, min_count: int = 0, num_partitions: int = 1,
                         seed: int = 42, embedding: str = "sharded", rounds: int = 1) -> list:
    """null drop -> clean -> tokens -> stop words -> assemble numerics -> min-max -> embedding ->
    assemble(embedding, scaled) -> select (all input columns kept, unlike the reference).  ``embedding``: "sharded", word
    vectors with the vocabulary in shards (``rounds`` passes); "none", the numbers only; "word2vec", the same
    with ``min_count`` and ``num_partitions``; or "hashed", token counts without a vocabulary."""
    if embedding not in ("sharded", "word2vec", "hashed", "none"):
        raise ValueError(f"unknown embedding {embedding!r}")
    if embedding == "sharded":
        embedder = ShardedWord2Vec(vectorSize=vector_size, maxIter=rounds, seed=seed, inputCol="tokens", outputCol="embedding")
    elif embedding == "none":
        embedder = None
    elif embedding == "hashed":
        embedder = hashed_embedding(vector_size, "tokens", "embedding")
    else:
        embedder = word2vec(vector_size=vector_size, min_count=min_count, num_partitions=num_partitions,
                            seed=seed, col="tokens", out="embedding")
    made = ["embedding"] if embedder else []
    return [
        null_drop_stage(["tweet", *NUMERIC_INPUTS]),
        cleaner_stage(),
        Tokenizer(inputCol="clean_tweet", outputCol="tokens_all"),
        StopWordsRemover(inputCol="tokens_all", outputCol="tokens", stopWords=tx.ENGLISH_STOP_WORDS),
        selector_stage(["* EXCEPT (clean_tweet, tokens_all)"]),  # before rows are dealt out to be embedded
        assemble(NUMERIC_INPUTS, "numeric_raw"),
        MinMaxScaler(inputCol="numeric_raw", outputCol="numeric_scaled"),  # fitted before texts are embedded
        *([embedder] if embedder else []),
        assemble([*made, "numeric_scaled"], "features"),
        selector_stage([f"* EXCEPT ({', '.join(['tokens', *made, 'numeric_raw, numeric_scaled'])})"]),
    ]


def _fit(df: DataFrame, stages: list) -> PipelineModel:
    """Fit the stages; the text is read, cleaned and cut into tokens once for all of them, and a regression at the end, which
    reads its rows several times, reads their features and labels from a table.  Both tables are deleted when all is fitted."""
    text, rest, spark = stages[:TEXT_STAGES], stages[TEXT_STAGES:], df.sparkSession
    tokens = df
    for stage in text:
        tokens = stage.transform(tokens)
    tokens = tokens.drop("tweet")  # what is fitted reads the tokens,
    if not any(s.hasParam("inputCol") and s.getOrDefault("inputCol") == "tokens" for s in rest):
        tokens = tokens.withColumn("tokens", F.lit(None).cast("array<string>"))  # or the numbers alone
    last = rest.pop() if isinstance(rest[-1], LinearRegression) else None
    with stored(tokens, "tokens") as tokens:
        made = Pipeline(stages=rest).fit(tokens)
        if last is not None:
            with rows_dropped(spark), stored(made.transform(tokens).select("features", TARGET), "features") as table:
                last = last.fit(table)
    return PipelineModel(stages=[*text, *made.stages, *([last] if last else [])])


@contextmanager
def rows_dropped(spark: SparkSession):
    """Rows that are written inside to be embedded are deleted when all that reads them is done."""
    before = len(rows_written())
    try:
        yield
    finally:
        drop_rows(spark, before)


def narrow(df: DataFrame, model: PipelineModel, columns) -> DataFrame:
    """The rows that the pipeline transforms, with ``columns`` only: the text is cut into tokens first, and neither it nor
    another column that isn't asked for goes where the rows are dealt out to be embedded."""
    for stage in model.stages[:TEXT_STAGES]:
        df = stage.transform(df)
    inputs = [c for c in df.columns if c in ("tokens", *NUMERIC_INPUTS) or c in columns]
    df = df.select(*inputs)
    for stage in model.stages[TEXT_STAGES:]:
        df = stage.transform(df)
    return df.select(*columns)


def fit_preprocessing(df: DataFrame, **kw) -> PipelineModel:
    return _fit(df, preprocessing_stages(**kw))


def fit_full_model(df: DataFrame, **kw) -> PipelineModel:
    """ONE pipeline: preprocessing + linear regression on the close; rows without a close
    don't train."""
    lr = LinearRegression(featuresCol="features", labelCol=TARGET)
    return _fit(df.dropna(subset=[TARGET]), [*preprocessing_stages(**kw), lr])


def write_training_table(df: DataFrame, model: PipelineModel, path: str) -> str:
    """The stored training table: (doc_id, features vector, close) as Parquet."""
    spark = df.sparkSession
    with rows_dropped(spark), exchanges_dropped(spark):
        narrow(df, model, ["doc_id", "features", TARGET]).write.mode("overwrite").parquet(path)
    return path


def train_from_table(spark: SparkSession, path: str) -> LinearRegressionModel:
    """The regression trained from a stored (features, close) table."""
    table = spark.read.parquet(path).dropna(subset=["features", TARGET])
    return LinearRegression(featuresCol="features", labelCol=TARGET).fit(table)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def drop_vectors(spark: SparkSession, model: PipelineModel) -> None:
    """Delete the tables of word vectors of a model that is not used any more (a saved one has its own)."""
    for stage in model.stages:
        if isinstance(stage, ShardedWord2VecModel):
            delete(spark, stage.path)


def load_model(path: str) -> PipelineModel:
    """Load from the GIVEN path, on any file system; a path without a model raises."""
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel, columns=None) -> DataFrame:
    """Raw rows -> clean -> preprocess -> predict (id columns kept, or ``columns`` only)."""
    return narrow(df, model, columns) if columns else model.transform(df)


def score_saved(df: DataFrame, path: str, columns=None) -> DataFrame:
    """Score raw rows with the pipeline saved at ``path`` (cleaning included)."""
    return score(df, load_model(path), columns)
