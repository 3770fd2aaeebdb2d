"""From documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the last return the columns of
``documents``, for the rows that they keep:

1. quality: documents scored under the threshold go; the model is learnt from ``labels`` of sf_dir;
2. near_duplicates: one document of each class stays (of smallest doc_id);
3. substrings: words of repeated 35-word windows go; a document that loses none keeps its text as it is,
   one that loses all stays with an empty text;
4. mixing: documents are sampled to target weights of source, language and topic;
5. packing: pieces of at most 4096 tokens with their places in sequences.

Null and empty texts pass every stage as empty texts; an empty table gives empty results.  A stage
deletes the intermediate tables of stages before it: by then their results are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textprice.llm import common
from textprice.llm.mixing import mix_sources
from textprice.llm.near_dedup import near_duplicates
from textprice.llm.packing import best_fit_packing
from textprice.llm.quality import score, train
from textprice.llm.queries import TOKENIZER, remainder_of_five
from textprice.llm.substring_dedup import substring_dedup
from textprice.session import scratch_path

LEFT: list[str] = []  # intermediate tables of the stage before


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels").where(remainder_of_five() != 0)
    return score(docs, train(docs, labels)).where("predicted = 1").select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates(docs).where("kept").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup(docs)
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, joint=True).where("selected").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # small slices, and nothing kept for later tasks: the executors' JVMs still hold memory of the stages before
    return best_fit_packing(docs.select("doc_id", "lang", "source", "text"), TOKENIZER, cached_words=150_000,
                            slice_bytes=1 << 20, keep_encoder=False)


def stage(function: Callable) -> Callable:
    """The stage as STAGES lists it: it first removes what the stage before left behind."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.remove(spark, list(LEFT))
        LEFT.clear()
        before = len(common.MADE)
        out = function(spark, docs, sf_dir)
        LEFT.extend(common.MADE[before:])
        return out

    return run_stage


STAGES = [(f.__name__, stage(f)) for f in (quality, near_duplicate, substrings, mixing, packing)]
ORACLE_SQL = None  # models, similarity classes, raked probabilities and packing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last."""
    docs = common.table(spark, sf_dir, "documents")
    for n, (name, function) in enumerate(STAGES):
        out = function(spark, docs, sf_dir)
        if n + 1 == len(STAGES):
            return out
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
