"""Queries of the operators on pieces, phrases and conversations, with their DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread, table
from .registry import register

PIECES = "piece_bpe_32k.model"


@register("op11_sentence_pieces")
def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentence_pieces import encode_pieces
    out = encode_pieces(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), PIECES)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


PHRASE_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(list_slice(ws, i, i + k - 1), ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) v(k)),
c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
q AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k >= 2 AND f >= 10),
x AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, ws FROM q),
y AS (SELECT x.lang, x.k, x.phrase, a, cut, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM x JOIN c l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1:cut], ' ')
             JOIN c r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[cut + 1:x.k], ' ')),
b AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part
      FROM q WHERE k = 3) GROUP BY ALL),
s AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.part = b.phrase WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a)
SELECT s.lang, rank, phrase, a, l, r, n, score FROM s JOIN t ON s.lang = t.lang WHERE rank <= 2000
"""


@register("op12_phrases", PHRASE_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import mine_phrases
    return mine_phrases(spread(table(spark, sf_dir, "documents").select("lang", "text")))


@register("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import FACTS, damage, repair_report
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = repair_report(damage(rows)).withColumnRenamed("conv_id", "_conv")
    ids = rows.select("conv_id").distinct()
    out = ids.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in FACTS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
