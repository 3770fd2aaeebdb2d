"""Plan tests: the physical plans we want at scale."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textprice.plans.catalog import QUERIES as Q
from textprice.plans.catalog import load_all

load_all()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parquet_scan_prunes_columns_and_pushes_filters(spark):
    df = Q["scan_parquet"](spark, SF_SMALL)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,click)]" in p
    assert "PartitionFilters: [isnotnull(dt" in p
    assert "ReadSchema: struct<doc_id:bigint,symbol:string,close:double>" in p


def test_top_n_is_take_ordered(spark):
    for name in ("latest_posts", "tail_posts", "head_n"):
        assert "TakeOrderedAndProject" in plan(Q[name](spark, SF_SMALL))


def test_per_symbol_top_n_limits_before_shuffle(spark):
    p = plan(Q["latest_per_symbol"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_lexicon_is_broadcast(spark):
    df = Q["lexicon_sentiment"](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_sql_checked_text_queries_have_no_python_udf(spark):
    for name in ("clean_text", "tokenize", "stopwords", "tfidf_stats", "daily_text", "attach_predictions",
                 "daily_rollup", "symbol_share", "rolling_stats", "walk_forward_1lag", "unit_root_lag0", "acf"):
        p = plan(Q[name](spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in p, (name, node)


def test_bars_use_partial_aggregation(spark):
    from textprice.sources import fixtures as fx
    p = plan(fx.bars(spark, SF_SMALL))
    assert p.count("HashAggregate") >= 2 and "SortAggregate" not in p   # partial + final, nothing sorted


def test_cleaner_runs_once_per_row(spark):
    from textprice.operators import textops
    from textprice.sources import fixtures as fx
    df = textops.clean_text(fx.posts(spark, SF_SMALL))
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("regexp_replace(regexp_replace(regexp_replace(regexp_replace") == 1
    assert df.filter(F.col("clean_tweet") == "").count() == 0


def test_cleaner_join_and_partial_aggregate_share_one_codegen_stage(spark):
    df = Q["daily_text"](spark, SF_SMALL)
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    gen = [ln for ln in lines if "Generate explode(array_remove" in ln]
    assert gen and all("*(" in ln for ln in gen[:1])


def test_building_plans_starts_no_job(spark):
    from textprice.plans.daily import daily_features
    from textprice.sources import fixtures as fx
    spark.sparkContext.setJobGroup("plan-only", "building plans")
    daily_features(fx.posts(spark, SF_SMALL), fx.lexicon(spark, SF_SMALL))
    # (operators that number rows, as acf on blocks does, write the positions once when they are called)
    for name in ("posts_with_bars", "tfidf_stats", "lexicon_sentiment", "attach_predictions", "posts_per_day"):
        Q[name](spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a Parquet footer for its schema is a job of one task; nothing else runs
    infos = [spark.sparkContext.statusTracker().getJobInfo(j) for j in jobs]
    tasks = [spark.sparkContext.statusTracker().getStageInfo(s).numTasks for i in infos if i for s in i.stageIds
             if spark.sparkContext.statusTracker().getStageInfo(s)]
    assert all(t == 1 for t in tasks), tasks
