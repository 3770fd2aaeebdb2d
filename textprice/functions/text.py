"""Text expressions.  Everything here is a built-in JVM expression (no Python UDF), so the
work stays inside whole-stage codegen and scales with the number of partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The post cleaner's patterns, applied in this order after lower-casing
# (Java regex; ``\w`` is ASCII).  1) emoji aliases  2) URLs  3) mentions and hashtags
# 4) punctuation and symbols except ``$`` and ``%``.
EMOJI_ALIAS_PATTERN = r":[a-z_]+:"
URL_PATTERN = r"http\S+|www\S+|https\S+"
MENTION_PATTERN = r"@\w+|#\w+"
PUNCT_PATTERN = r"[^\w\s$%]"
# The same places, found several times as fast: Java is slow to look for a class of all but some classes
PUNCT_SEARCH = r"[^a-z ](?<![\w\s$%])"
CLEAN_STEPS = ("lower", "emoji_alias", "urls", "mentions", "punct")

# Word pattern of the TF-IDF analysis (runs of two or more Unicode letters/digits/underscore).
TFIDF_WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Word pattern of the lexicon (lower-case ASCII words of three letters or more).
LEXICON_WORD_PATTERN = r"[a-z]{3,}"

# Spark's default English stop-word list (StopWordsRemover "english"), which
# the reference's fitted remover carries; matched case-insensitively.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]


def clean_step(c: Column, step: str) -> Column:
    if step == "lower":
        return F.lower(c)
    pattern = {"emoji_alias": EMOJI_ALIAS_PATTERN, "urls": URL_PATTERN,
               "mentions": MENTION_PATTERN, "punct": PUNCT_SEARCH}[step]
    return F.regexp_replace(c, F.lit(pattern), F.lit(""))


PLAIN_SIGNS = (":", "@", "#", "http", "www")  # a lower-case text without any of these is changed by the last step only


def clean_expr(c: Column, upto: str = "punct") -> Column:
    """The composed cleaner as ONE nested expression (collapses into a single projection)."""
    out = c
    for step in CLEAN_STEPS:
        out = clean_step(out, step)
        if step == upto:
            break
    if upto != "punct":
        return out
    low, signs = F.lower(c), F.lit(False)
    for sign in PLAIN_SIGNS:
        signs = signs | low.contains(sign)
    return F.when(~signs, clean_step(low, "punct")).otherwise(out)


def clean_sql(col_name: str) -> str:
    """Same cleaner as Spark SQL text (used by the persistable SQLTransformer stage)."""
    e = low = f"lower({col_name})"
    for pattern in (EMOJI_ALIAS_PATTERN, URL_PATTERN, MENTION_PATTERN, PUNCT_SEARCH):
        e = f"regexp_replace({e}, r'{pattern}', '')"
    signs = " OR ".join(f"contains({low}, '{sign}')" for sign in PLAIN_SIGNS)
    return f"CASE WHEN {signs} THEN {e} ELSE regexp_replace({low}, r'{PUNCT_SEARCH}', '') END"


def words(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({pattern})"), 1)
