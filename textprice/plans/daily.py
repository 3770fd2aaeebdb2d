"""Daily feature table per (symbol, day): roll-up, post count, lexicon sentiment,
TF-IDF statistics, then per-symbol min-max and standard scaling (notebook order: min-max on
one column set, standard score on top on an overlapping set; the target is scaled too)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import group_minmax, group_standardize
from ..operators.joins import join_small
from ..operators.stats import daily_rollup
from ..operators.textops import lexicon_sentiment, tfidf_stats

KEYS = ["symbol", "dt"]
MINMAX_COLS = ["volume", "n_posts", "max_tfidf", "mean_tfidf", "sum_tfidf", "close"]
STANDARD_COLS = ["volume", "open", "n_posts", "max_tfidf", "mean_tfidf", "sum_tfidf", "close"]
OUT_COLS = ["open", "high", "low", "close", "volume", "n_posts", "polarity", "subjectivity",
            "max_tfidf", "mean_tfidf", "sum_tfidf"]


def daily_features(posts: DataFrame, lexicon: DataFrame, scale: bool = True) -> DataFrame:
    roll = daily_rollup(posts).drop("adj_close", "text_chars", "text_fp") \
        .withColumn("n_posts", F.col("n_posts").cast("double"))
    d = join_small(roll, lexicon_sentiment(posts, lexicon), KEYS, "left")
    d = join_small(d, tfidf_stats(posts), KEYS, "left")
    if scale:
        d = group_minmax(d, MINMAX_COLS, "symbol")
        d = group_standardize(d, STANDARD_COLS, "symbol")
    return d.select(*KEYS, *OUT_COLS)
