"""Text operators (C1-C13): cleaning, tokens, stop words, embedding, daily text, TF-IDF,
lexicon sentiment, vocabulary.

Per-document work is built-in expressions (regexp_replace, split, filter) – no Python UDF.
Per-day text statistics never build the day's joined document: words are exploded per post
and counted with partial aggregation, so a hot (symbol, day) is pre-reduced on every map task.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .embedding import ShardedWord2Vec
from .joins import join_small


def clean_step(df: DataFrame, step: str, col: str = "tweet", out: str = "clean_tweet") -> DataFrame:
    """One cleaning step on its own (from the raw text up to and including ``step``
    would be ``clean_text(..., upto=step)``)."""
    return df.withColumn(out, tx.clean_step(F.col(col), step))


def clean_text(df: DataFrame, col: str = "tweet", out: str = "clean_tweet",
               drop_empty: bool = True, upto: str = "punct") -> DataFrame:
    """Composed cleaner in one projection; rows whose cleaned text is exactly '' (or null)
    are dropped (B6).

    The drop is fused into the projection as a 0-or-1-row generator: a plain
    ``filter(clean != '')`` would be pushed below the projection (and below any exchange),
    re-evaluating the four regexes for the filter and again for the column."""
    cleaned = tx.clean_expr(F.col(col), upto)
    if not drop_empty:
        return df.withColumn(out, cleaned)
    # null -> '' -> removed; every function here has generated code (no lambda), so the
    # generator stays inside whole-stage codegen
    kept = F.explode(F.array_remove(F.array(F.coalesce(cleaned, F.lit(""))), ""))
    return df.select("*", kept.alias(out))


def tokenize(df: DataFrame, col: str = "clean_tweet", out: str = "tokens_all") -> DataFrame:
    """ML Tokenizer (lower-case + split on single whitespace)."""
    return Tokenizer(inputCol=col, outputCol=out).transform(df)


def remove_stop_words(df: DataFrame, col: str = "tokens_all", out: str = "tokens") -> DataFrame:
    """Spark's English stop words, case-insensitive; repeats of kept words stay."""
    return StopWordsRemover(inputCol=col, outputCol=out, stopWords=tx.ENGLISH_STOP_WORDS,
                            caseSensitive=False).transform(df)


def word2vec(vector_size: int = 100, min_count: int = 0, window: int = 5, max_iter: int = 1,
             step_size: float = 0.025, num_partitions: int = 1, seed: int = 42,
             col: str = "tokens", out: str = "embedding") -> ShardedWord2Vec:
    """Document embedding estimator (document vector = mean of its word vectors).

    Defaults are the reference's settings.  The vocabulary is in shards, not on the driver; ``num_partitions`` parts of
    the texts at least are trained beside each other and averaged."""
    return ShardedWord2Vec(vectorSize=vector_size, minCount=min_count, windowSize=window,
                           maxIter=max_iter, stepSize=step_size, leastGroups=num_partitions,
                           seed=seed, inputCol=col, outputCol=out)


def hashed_embedding(vector_size: int = 100, col: str = "tokens", out: str = "embedding") -> HashingTF:
    """Document vectors without a vocabulary: token counts hashed into ``vector_size`` places.  Nothing is
    gathered or broadcast, whatever the number of words; chosen by an explicit argument of the
    pipelines, never by size."""
    return HashingTF(numFeatures=vector_size, inputCol=col, outputCol=out)


def daily_words(posts: DataFrame, pattern: str, keys=("symbol", "dt"), lower: bool = True) -> DataFrame:
    src = F.lower("tweet") if lower else F.col("tweet")
    return posts.select(*keys, F.explode(tx.words(src, pattern)).alias("word"))


def tfidf_stats(posts: DataFrame, keys=("symbol", "dt"), corpus_key: str = "symbol") -> DataFrame:
    """TF-IDF of each day's document (all posts of the day), one corpus per symbol.

    tf = raw count, idf = ln((1 + n) / (1 + df)) + 1 (smooth), rows L2-normalised; per
    document the max, the sum and the mean over the corpus vocabulary (zeros included).
    Days whose text has no word get 0.

    One pass over the word counts: document frequency and "first day of this word" come from
    one window per (symbol, word) — at most one row per day, so bounded — and the vocabulary
    size is the per-symbol sum of first occurrences over the per-day table."""
    keys = list(keys)
    src = F.lower("tweet")
    w = posts.select(*keys, F.explode_outer(tx.words(src, tx.TFIDF_WORD_PATTERN)).alias("word"))
    tf = w.groupBy(*keys, "word").agg(F.count("word").alias("tf"))
    win = Window.partitionBy(corpus_key, "word")
    has = F.col("word").isNotNull()
    tf = tf.withColumn("df", F.when(has, F.count(F.lit(1)).over(win))) \
        .withColumn("first", F.when(has & (F.row_number().over(win.orderBy(*[k for k in keys if k != corpus_key])) == 1), 1)
                    .otherwise(0))
    # documents per corpus: from the (symbol, day) keys only (column-pruned, no text read)
    n_docs = posts.select(*keys).distinct().groupBy(corpus_key).agg(F.count(F.lit(1)).alias("n_docs"))
    x = join_small(tf, n_docs, [corpus_key], "inner") \
        .withColumn("x", F.when(has, F.col("tf") * (F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1)))
    per_doc = x.groupBy(*keys).agg(F.max("x").alias("mx"), F.sum("x").alias("sx"),
                                   F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("nrm"),
                                   F.sum("first").alias("new_words"))
    n_vocab = F.sum("new_words").over(Window.partitionBy(corpus_key))
    per_doc = per_doc.withColumn("n_vocab", n_vocab)
    nz = F.coalesce(F.col("nrm"), F.lit(0.0)) > 0
    return per_doc.select(*keys,
                          F.when(nz, F.col("mx") / F.col("nrm")).otherwise(F.lit(0.0)).alias("max_tfidf"),
                          F.when(nz, F.col("sx") / F.col("nrm") / F.col("n_vocab")).otherwise(F.lit(0.0)).alias("mean_tfidf"),
                          F.when(nz, F.col("sx") / F.col("nrm")).otherwise(F.lit(0.0)).alias("sum_tfidf"))


def vocabulary(posts: DataFrame, corpus_key: str = "symbol", keys=("symbol", "dt")) -> DataFrame:
    """The TF-IDF vocabulary of each corpus with its document frequency."""
    words = daily_words(posts, tx.TFIDF_WORD_PATTERN, keys).distinct()
    return words.groupBy(corpus_key, "word").agg(F.count(F.lit(1)).alias("doc_freq"))


LEXICON_PRIOR, LEXICON_Z = 1000.0, 1.96  # words of prior knowledge; standard errors from 0 that make a word an opinion


def learn_lexicon(posts: DataFrame, bars: DataFrame, prior: float = LEXICON_PRIOR, least_z: float = LEXICON_Z) -> DataFrame:
    """(word, polarity, subjectivity) learnt from what followed: log-odds of a word in posts of days after which
    the symbol's close rose against days after which it fell, with an informative Dirichlet prior of ``prior``
    words in the corpus's own shares, over its standard error (z).  Words with z of at least ``least_z`` either way are kept, polarity
    z / sqrt(1 + z²), subjectivity z² / (1 + z²).  ``bars``: (symbol, dt, close).

    Words are counted in one partial aggregate; the two totals are a row joined to it."""
    later = F.lead("close").over(Window.partitionBy("symbol").orderBy("dt"))  # one row per day
    days = bars.select("symbol", "dt", F.when(later > F.col("close"), 1).when(later < F.col("close"), 0).alias("up")).filter("up IS NOT NULL")
    told = join_small(posts.select("symbol", "dt", "tweet"), days, ["symbol", "dt"], "inner")
    words = told.select("up", F.explode(tx.words(F.lower("tweet"), tx.LEXICON_WORD_PATTERN)).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("up").alias("rose"))
    totals = counts.agg(F.sum("n").alias("all_n"), F.sum("rose").alias("all_rose"))
    c = counts.join(F.broadcast(totals))  # one row
    a = F.lit(float(prior)) * F.col("n") / F.col("all_n")
    up, down = F.col("rose") + a, F.col("n") - F.col("rose") + a
    all_up, all_down = F.col("all_rose") + F.lit(float(prior)), F.col("all_n") - F.col("all_rose") + F.lit(float(prior))
    # a corpus of one word has no odds
    odds = F.log(F.try_divide(up, all_up - up)) - F.log(F.try_divide(down, all_down - down))
    z = c.select("word", (odds / F.sqrt(1 / up + 1 / down)).alias("z")).filter(F.abs("z") >= least_z)
    return z.select("word", (F.col("z") / F.sqrt(1 + F.col("z") * F.col("z"))).alias("polarity"),
                    (F.col("z") * F.col("z") / (1 + F.col("z") * F.col("z"))).alias("subjectivity"))


def lexicon_sentiment(posts: DataFrame, lexicon: DataFrame, keys=("symbol", "dt")) -> DataFrame:
    """C12 (re-aimed): mean polarity and subjectivity of the lexicon words of each day's text;
    0 when the day has none.  The lexicon is joined by broadcast after its size is checked."""
    keys = list(keys)
    w = daily_words(posts, tx.LEXICON_WORD_PATTERN, keys)
    hits = join_small(w, lexicon, ["word"], "inner")
    scored = hits.groupBy(*keys).agg(F.avg("polarity").alias("pol"), F.avg("subjectivity").alias("subj"))
    days = posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    out = join_small(days, scored, keys, "left")
    return out.select(*keys, F.coalesce("pol", F.lit(0.0)).alias("polarity"),
                      F.coalesce("subj", F.lit(0.0)).alias("subjectivity"))
