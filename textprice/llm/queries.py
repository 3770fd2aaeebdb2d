"""One query per operator over the driver's tables, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries_text  # noqa: F401  (registers its queries)
from .common import spread, table
from .registry import ORACLES, QUERIES, register  # noqa: F401

SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, list_slice(ws, i, i + 34) AS win FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM h) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM r),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY k) AS kept_text, count(*) AS n
         FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.k = gone.k GROUP BY words.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@register("op1_substring_dedup", SUBSTRING_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


TOKENIZER = "word_bpe_49k.json"


@register("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_packing
    out = best_fit_packing(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), TOKENIZER)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def remainder_of_five(key: str = "doc_id"):
    """crc32 of the id as text, modulo 5: the fold that fixes training and held-out rows."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


@register("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score, train
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = table(spark, sf_dir, "labels").where(remainder_of_five() != 0)
    weights = train(docs, labels)
    return score(docs, weights).select("doc_id", F.coalesce(remainder_of_five() == 0, F.lit(False)).alias("held_out"),
                                       "score", "predicted")


# The rules of the URL filter, as (verdict, host, path).
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))

URL_SQL = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id,
             translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
             regexp_replace(host, '^(www|m)\.', '') || regexp_replace(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '(/|\.html)$', '') AS key FROM p),
s AS (SELECT *, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
                     WHEN rule IS NOT NULL THEN 'allow' END AS said FROM r),
l AS (SELECT DISTINCT key FROM s WHERE said = 'block')
SELECT page_id, host, path, rule, l.key IS NOT NULL AS listed,
       coalesce(said, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN l ON s.key = l.key
"""


@register("op4_url_filter", URL_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls
    out = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "listed", "verdict")


NEAREST_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id,
             sqrt(list_reduce(list_transform(list_zip(c.e, q.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@register("op10_one_bit_search", NEAREST_SQL)
def op10_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .one_bit_search import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, "vec_id", "embedding", 10)


@register("op6_syncmer_fingerprints")
def op6_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .syncmers import fingerprint_with_next
    out = fingerprint_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited_text"), 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint", "positions", "edited_positions", "near_edited", "near_next",
                      "aligned_edited", "aligned_next")


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                 ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END) AS sh
      FROM w WHERE len(ws) > 0),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sh) AS rep, sh FROM (SELECT doc_id, list_sort(sh) AS sh FROM s)),
r AS (SELECT doc_id, sh FROM c WHERE doc_id = rep),
e AS (SELECT doc_id, unnest(sh) AS x, len(sh) AS n FROM r),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE common / (na + nb - common) >= 0.8),
reach AS (SELECT doc_id AS a, doc_id AS b FROM r UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
m AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(m.class_id, w.doc_id) AS class_id, w.doc_id = coalesce(m.class_id, w.doc_id) AS kept
FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN m ON c.rep = m.a
"""


@register("op2_near_duplicates", NEAR_SQL)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), rows=False)


@register("op7_maxent_lm")
def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .maxent_lm import score_language_model
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", F.coalesce(remainder_of_five() == 1, F.lit(False))).withColumn("train", ~F.col("held_out"))
    return score_language_model(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op5_mix_sources")
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources
    out = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), joint=True)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected")


def license_sql() -> str:
    from .licenses import TEMPLATES
    listed = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(TEMPLATES))
    words = (r"list_filter(list_transform(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9.\-\x{{80}}-\x{{10FFFF}}]+'), lambda w: rtrim(w, '.')), lambda w: w <> '')")
    grams = ("list_distinct(CASE WHEN len({0}) = 1 THEN {0} ELSE list_transform(range(1, len({0})), "
             "lambda i: {0}[i] || ' ' || {0}[i + 1]) END)")
    return f"""
WITH t AS (SELECT * FROM (VALUES {listed}) v(nth, name, body)),
tw AS (SELECT nth, name, {words.format('body')} AS w FROM t),
tb AS (SELECT nth, name, {grams.format('w')} AS g FROM tw),
d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, 1 AS line, unnest(ls) AS x FROM d UNION ALL SELECT doc_id, 0, text FROM d WHERE len(ls) > 1),
cw AS (SELECT doc_id, line, {words.format('x')} AS w FROM c),
cb AS (SELECT doc_id, line, row_number() OVER () AS r, {grams.format('w')} AS g FROM cw WHERE len(w) > 0),
m AS (SELECT doc_id, line, r, nth, name, 2 * len(list_intersect(cb.g, tb.g)) / (len(cb.g) + len(tb.g)) AS score
      FROM cb JOIN tb ON len(cb.g) BETWEEN len(tb.g) * 0.5 AND len(tb.g) * 2),
h AS (SELECT * FROM m WHERE score >= 0.8),
b AS (SELECT doc_id, first(name ORDER BY score DESC, nth) AS license, max(score) AS license_score,
             count(DISTINCT CASE WHEN line = 1 THEN r END) AS n FROM h GROUP BY doc_id)
SELECT d.doc_id, license, license_score, coalesce(n, 0)::BIGINT AS n_license_lines FROM d LEFT JOIN b ON d.doc_id = b.doc_id
"""


@register("op8_license_scan", license_sql())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import FULL_TEXTS, TEMPLATES, scan_licenses
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = scan_licenses(docs, templates=(*TEMPLATES, *FULL_TEXTS), spans=True)
    return out.select("doc_id", "license", "license_score", "n_license_lines")
