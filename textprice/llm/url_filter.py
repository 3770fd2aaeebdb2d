"""URL filter: allow and block rules, and a Bloom filter cascade for the keys of a block list.

Method.  ``build_cascade`` takes the complete key universe of the corpus with a mark on the listed
keys.  Level 1 is a Bloom filter of the listed keys; level 2 one of the unlisted keys that level 1
lets through; level 3 one of the listed keys that level 2 lets through; and so on until a level
lets nothing through.  A key's first level that does not hold it tells its side, so membership is
exact for every key of the universe, and no key list is joined or shipped.

The cascade is cut into shards by key hash, each one row with a few bit arrays of bounded size, so
that it grows in rows and not in row size.  A page looks its shard's row up by number: Spark
broadcasts the cascade only if it measures it small, and splits skewed shards otherwise.

Everything is SQL expressions: hashing by ``xxhash64``, bits set by ``bit_or`` under ``groupBy`` (a
key given by a third of all rows is one universe row), tested by ``getbit``.

Results for special inputs: a null url, or one without ``://``, has an empty host and path and no
rule fits it; repeated pages get one row each; an empty block list blocks nothing; an empty table
gives an empty result; an input column with the name of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MADE, drop_intermediates, quoted, without, written

BITS_PER_KEY = 10
HASHES = 6
SHARD_KEYS = 1 << 13
MAX_LEVELS = 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUTPUTS = ("host", "path", "rule", "listed", "verdict")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_key(host: Column, path: Column) -> Column:
    """One key for the spellings of a page: no leading ``www.`` or ``m.``, A-Z of the path
    lower-cased, no closing ``/`` or ``.html``."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""),
                    F.regexp_replace(F.translate(path, UPPER, LOWER), r"(/|\.html)$", ""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits, else nulls.  ``rules``: (verdict, host,
    path) triples; one fits its host and all subdomains where the path starts with the rule's."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest ends up outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards))


def places(key: Column, level: int, words: int) -> list[Column]:
    """Bit numbers of a key in its shard's array of ``words`` 64-bit words."""
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + j)), F.lit(words * 64)) for j in range(HASHES)]


def holds(array: Column, key: Column, level: int, words: int) -> Column:
    out = F.lit(True)
    for p in places(key, level, words):
        out = out & (F.getbit(F.get(array, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1)
    return out


def encode_level(keys: DataFrame, level: int, words: int, shards: int) -> DataFrame:
    """(shard, bits): one dense array per shard, empty shards too."""
    set_bits = (keys.select("shard", F.explode(F.array(*places(F.col("key"), level, words))).alias("p"))
                .select("shard", F.floor(F.col("p") / 64).alias("word"),
                        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int")).alias("v")))
    zero = keys.sparkSession.range(shards * words).select(
        F.floor(F.col("id") / words).alias("shard"), (F.col("id") % words).alias("word"), F.lit(0).cast("long").alias("v"))
    dense = set_bits.unionByName(zero).groupBy("shard", "word").agg(F.bit_or("v").alias("v"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "v")))  # ``words`` entries
    return dense.groupBy("shard").agg(F.transform(ordered, lambda x: x["v"]).alias("bits"))


class Cascade:
    """Bit arrays by shard (``table``: shard, b1, b2, ...), the words of each level's arrays and the
    number of shards."""

    def __init__(self, table: DataFrame | None, words: list[int], shards: int):
        self.table, self.words, self.shards = table, words, shards

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with boolean ``name``: whether ``key``, a key of the universe, is listed."""
        if self.table is None:
            return df.withColumn(name, F.lit(False))
        levels = len(self.words)
        answer = F.lit(levels % 2 == 1)
        for n in range(levels, 0, -1):
            answer = F.when(~holds(F.col(f"_b{n}"), key, n, self.words[n - 1]), F.lit(n % 2 == 0)).otherwise(answer)
        side = self.table.select(F.col("shard").alias("_shard"), *[F.col(f"b{n}").alias(f"_b{n}") for n in range(1, levels + 1)])
        keep = [quoted(c) for c in df.columns]
        return (df.withColumn("_shard", shard_of(key, self.shards)).join(side, "_shard")
                .select(*keep, answer.alias(name)))


def build_cascade(universe: DataFrame, bits_per_key: int = BITS_PER_KEY, shard_keys: int = SHARD_KEYS) -> Cascade:
    """``universe``: every key once (``key``, not null) and whether it is ``listed``."""
    sizes = {r["listed"]: r["n"] for r in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    n = sizes.get(True, 0)
    if not n:
        return Cascade(None, [], 1)
    shards, before = 1 + n // shard_keys, len(MADE)
    whole = written(universe.withColumn("shard", shard_of(F.col("key"), shards)), "url-keys")
    encode, test = whole.where("listed").select("shard", "key"), whole.where("NOT listed").select("shard", "key")
    table, words = None, []
    while n:
        level = len(words) + 1
        if level > MAX_LEVELS:
            raise ValueError("the cascade does not end: two keys of the universe have equal hashes")
        # shards can get uneven from level to level: the fullest one sizes the arrays
        fullest = encode.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        words.append(1 + fullest * bits_per_key // 64)
        arrays = written(encode_level(encode, level, words[-1], shards).withColumnRenamed("bits", f"b{level}"), f"bloom-{level}")
        table = arrays if table is None else table.join(arrays, "shard")
        through = written(test.join(arrays, "shard").where(holds(F.col(f"b{level}"), F.col("key"), level, words[-1]))
                          .select("shard", "key"), f"through-{level}")
        encode, test, n = through, encode, through.count()
    cascade = written(table, "cascade")
    drop_intermediates(universe.sparkSession, before, ("cascade",))
    return Cascade(cascade, words, shards)


def filter_urls(pages: DataFrame, rules, url: str = "url", listed=None) -> DataFrame:
    """``pages`` with host, path, rule, listed and verdict.  ``listed``: condition (host, path, rule
    verdict) -> Column that says of which pages the key is on the block list; by default those that
    a block rule fits, so that other spellings of a blocked page are blocked with it."""
    keep = without(pages, OUTPUTS)
    host, path = F.col("host"), F.col("path")
    text, verdict = rule_of(host, path, rules)
    judged = (pages.select(*[quoted(c) for c in keep], host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path"))
              .withColumn("rule", text).withColumn("_said", verdict))
    on_list = (listed or (lambda h, p, v: v == "block"))(host, path, F.col("_said"))
    universe = (judged.select(url_key(host, path).alias("key"), F.coalesce(on_list, F.lit(False)).alias("l"))
                .groupBy("key").agg(F.max("l").alias("listed")))
    cascade = build_cascade(universe)
    return (cascade.mark(judged, url_key(host, path), "listed")
            .withColumn("verdict", F.coalesce("_said", F.when(F.col("listed"), "block").otherwise("allow")))
            .select(*[quoted(c) for c in keep], *OUTPUTS))
