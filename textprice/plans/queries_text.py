"""Registered text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import stats, textops
from ..session import stored
from ..sources import fixtures as fx
from .catalog import register
from .oracle import clean_sql, fingerprint_sql, tokens_sql

_STEP_SQL = {
    "lower": "lower(tweet)",
    "emoji_alias": "regexp_replace(lower(tweet), ':[a-z_]+:', '', 'g')",
    "urls": r"regexp_replace(regexp_replace(lower(tweet), ':[a-z_]+:', '', 'g'), 'http\S+|www\S+|https\S+', '', 'g')",
    "mentions": r"regexp_replace(regexp_replace(regexp_replace(lower(tweet), ':[a-z_]+:', '', 'g'), 'http\S+|www\S+|https\S+', '', 'g'), '@\w+|#\w+', '', 'g')",
    "punct": clean_sql("tweet"),
}


def _step_query(step):
    def q(spark, sf):
        df = textops.clean_text(fx.posts_marked(spark, sf), upto=step, drop_empty=False)
        return df.select("doc_id", F.md5("clean_tweet").alias("text_md5"),
                         F.length("clean_tweet").alias("n_chars"))
    return q


for _name, _step in [("clean_lower", "lower"), ("clean_emoji_alias", "emoji_alias"),
                     ("clean_urls", "urls"), ("clean_mentions", "mentions"), ("clean_punct", "punct")]:
    register(_name, f"SELECT doc_id, md5({_STEP_SQL[_step]}) AS text_md5, "
                    f"CAST(length({_STEP_SQL[_step]}) AS INTEGER) AS n_chars FROM posts_marked")(_step_query(_step))


@register("clean_text", f"""
SELECT doc_id, clean_tweet FROM (SELECT doc_id, {clean_sql('tweet')} AS clean_tweet FROM posts_marked)
WHERE clean_tweet <> ''""")
def clean_text(spark, sf):
    return textops.clean_text(fx.posts_marked(spark, sf)).select("doc_id", "clean_tweet")


def _clean_posts(spark, sf):
    return textops.clean_text(fx.posts(spark, sf))


_TOK_CTE = f""", toks AS (SELECT doc_id, {tokens_sql('clean_tweet')} AS tokens_all
                FROM clean_posts WHERE clean_tweet <> '')"""


@register("tokenize", _TOK_CTE + """
SELECT doc_id, CAST(len(tokens_all) AS INTEGER) AS n_tokens, md5(array_to_string(tokens_all, '|')) AS tokens_md5 FROM toks""")
def tokenize(spark, sf):
    t = textops.tokenize(_clean_posts(spark, sf))
    return t.select("doc_id", F.size("tokens_all").alias("n_tokens"),
                    F.md5(F.array_join("tokens_all", "|")).alias("tokens_md5"))


def _stop_list_sql():
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in tx.ENGLISH_STOP_WORDS) + "]"


@register("stopwords", _TOK_CTE + f"""
, kept AS (SELECT doc_id, list_filter(tokens_all, lambda x: NOT list_contains({_stop_list_sql()}, lower(x))) AS tokens FROM toks)
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, '|')) AS tokens_md5 FROM kept""")
def stopwords(spark, sf):
    t = textops.remove_stop_words(textops.tokenize(_clean_posts(spark, sf)))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))


@register("daily_text", f"""
SELECT symbol, CAST(dt AS VARCHAR) AS dt, count(*) AS n_posts,
       CAST(sum(length(clean_tweet)) + count(clean_tweet) - 1 AS BIGINT) AS text_chars,
       CAST(sum({fingerprint_sql('clean_tweet')}) AS BIGINT) AS text_fp
FROM clean_posts WHERE clean_tweet <> '' GROUP BY symbol, dt""")
def daily_text(spark, sf):
    c = _clean_posts(spark, sf)
    g = c.groupBy("symbol", "dt").agg(
        F.count(F.lit(1)).alias("n_posts"),
        (F.sum(F.length("clean_tweet")) + F.count("clean_tweet") - 1).cast("long").alias("text_chars"),
        F.sum(stats.text_fingerprint(F.col("clean_tweet"))).cast("long").alias("text_fp"))
    return g.withColumn("dt", F.col("dt").cast("string"))


_TFIDF_CTE = r""", w AS (SELECT symbol, dt, unnest(regexp_extract_all(lower(tweet), '[\p{L}\p{N}_]{2,}')) AS word FROM posts),
tf AS (SELECT symbol, dt, word, count(*) AS tf FROM w GROUP BY symbol, dt, word),
dfq AS (SELECT symbol, word, count(*) AS df FROM tf GROUP BY symbol, word),
days AS (SELECT DISTINCT symbol, dt FROM posts),
nd AS (SELECT symbol, count(*) AS n_docs FROM days GROUP BY symbol),
voc AS (SELECT symbol, count(*) AS n_vocab FROM dfq GROUP BY symbol),
x AS (SELECT tf.symbol, tf.dt, tf.tf * (ln((nd.n_docs + 1.0) / (dfq.df + 1.0)) + 1) AS x
      FROM tf JOIN dfq USING (symbol, word) JOIN nd USING (symbol)),
per AS (SELECT symbol, dt, max(x) AS mx, sum(x) AS sx, sqrt(sum(x * x)) AS nrm FROM x GROUP BY symbol, dt)
"""


@register("tfidf_stats", _TFIDF_CTE + """
SELECT d.symbol, CAST(d.dt AS VARCHAR) AS dt,
       round(coalesce(CASE WHEN nrm > 0 THEN mx / nrm END, 0.0), 8) AS max_tfidf,
       round(coalesce(CASE WHEN nrm > 0 THEN sx / nrm / n_vocab END, 0.0), 8) AS mean_tfidf,
       round(coalesce(CASE WHEN nrm > 0 THEN sx / nrm END, 0.0), 8) AS sum_tfidf
FROM days d LEFT JOIN per USING (symbol, dt) LEFT JOIN voc USING (symbol)""")
def tfidf_stats(spark, sf):
    t = textops.tfidf_stats(fx.posts(spark, sf))
    return t.select("symbol", F.col("dt").cast("string").alias("dt"),
                    *[F.round(c, 8).alias(c) for c in ("max_tfidf", "mean_tfidf", "sum_tfidf")])


@register("vocabulary", r"""
, w AS (SELECT DISTINCT symbol, dt, unnest(regexp_extract_all(lower(tweet), '[\p{L}\p{N}_]{2,}')) AS word FROM posts)
SELECT symbol, word, count(*) AS doc_freq FROM w GROUP BY symbol, word""")
def vocabulary(spark, sf):
    return textops.vocabulary(fx.posts(spark, sf))


@register("lexicon_sentiment", """
, w AS (SELECT symbol, dt, unnest(regexp_extract_all(lower(tweet), '[a-z]{3,}')) AS word FROM posts),
sc AS (SELECT symbol, dt, avg(polarity) AS pol, avg(subjectivity) AS subj FROM w JOIN lexicon USING (word) GROUP BY symbol, dt),
days AS (SELECT DISTINCT symbol, dt FROM posts)
SELECT symbol, CAST(dt AS VARCHAR) AS dt, round(coalesce(pol, 0.0), 9) AS polarity,
       round(coalesce(subj, 0.0), 9) AS subjectivity
FROM days LEFT JOIN sc USING (symbol, dt)""")
def lexicon_sentiment(spark, sf):
    s = textops.lexicon_sentiment(fx.posts(spark, sf), fx.lexicon(spark, sf))
    return s.select("symbol", F.col("dt").cast("string").alias("dt"),
                    F.round("polarity", 9).alias("polarity"), F.round("subjectivity", 9).alias("subjectivity"))


def _tokens(spark, sf):
    return textops.remove_stop_words(textops.tokenize(_clean_posts(spark, sf)))


@register("embed_text", "SELECT doc_id, 100 AS dim, true AS finite FROM clean_posts WHERE clean_tweet <> ''")
def embed_text(spark, sf):
    """Word2Vec document vectors of the cleaned, stop-word-free posts."""
    from pyspark.ml.functions import vector_to_array
    with stored(_tokens(spark, sf).select("doc_id", "tokens"), "tokens") as t:
        e = textops.word2vec(vector_size=100, num_partitions=spark.sparkContext.defaultParallelism).fit(t).transform(t)
    v = vector_to_array("embedding")
    return e.select("doc_id", F.size(v).alias("dim"), F.forall(v, lambda x: F.abs(x) < float("inf")).alias("finite"))


@register("embed_sharded", _TOK_CTE + f"""
SELECT doc_id, 100 AS dim, len(list_filter(tokens_all, lambda x: NOT list_contains({_stop_list_sql()}, lower(x)))) > 0 AS moved, true AS finite FROM toks""")
def embed_sharded(spark, sf):
    """Document vectors by skip-gram with the vocabulary in shards, fitted and applied on whole texts; a document's
    vector is not zero exactly if it has tokens."""
    from pyspark.ml.functions import vector_to_array

    from ..operators.embedding import ShardedWord2Vec
    with stored(_tokens(spark, sf).select("doc_id", "tokens"), "tokens") as t:
        e = ShardedWord2Vec(vectorSize=100, maxIter=1).fit(t).transform(t)
    v = vector_to_array("embedding")
    return e.select("doc_id", F.size(v).alias("dim"), F.exists(v, lambda x: x != 0).alias("moved"),
                    F.forall(v, lambda x: F.abs(x) < float("inf")).alias("finite"))


@register("embed_hashed", _TOK_CTE + f"""
SELECT doc_id, 100 AS dim, CAST(len(list_filter(tokens_all, lambda x: NOT list_contains({_stop_list_sql()}, lower(x)))) AS DOUBLE) AS mass FROM toks""")
def embed_hashed(spark, sf):
    """C9 without a vocabulary: hashed token counts; their sum is the number of tokens."""
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array("embedding")
    e = textops.hashed_embedding(100).transform(_tokens(spark, sf))
    return e.select("doc_id", F.size(v).alias("dim"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("mass"))


@register("daily_posts", """
SELECT symbol, CAST(dt AS VARCHAR) AS dt, doc_id, CAST(row_number() OVER (PARTITION BY symbol, dt ORDER BY doc_id) AS BIGINT) AS position,
       md5(tweet) AS tweet_md5 FROM posts""")
def daily_posts(spark, sf):
    """The day's ordered list of posts, in long form (no list per day is built)."""
    from ..operators.ordering import row_index
    p = row_index(fx.posts(spark, sf), ["doc_id"], ["symbol", "dt"], "position")
    return p.select("symbol", F.col("dt").cast("string").alias("dt"), "doc_id", "position", F.md5("tweet").alias("tweet_md5"))
