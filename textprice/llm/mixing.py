"""Mixing sources to target weights: token weights raked to source, language and topic marginals by
iterative proportional fitting, then documents sampled with calibrated probabilities.

Method.  The corpus is reduced to token counts per (source, language, topic) cell.  The fitted weight of
a cell is its tokens times one factor per source, per language and per topic.  Languages are those of the corpus, found
by one aggregation (codes: more than ``MAX_LANGUAGES`` different ones are an error), topics a given list with one place
for all others, so their marginals are a bounded matrix; sources may be any number.  A round sets every
source's factor in its row of the cell table, and one aggregation
brings back the language-by-topic matrix of fitted tokens, from which the language factors and then the
topic factors are set.  Rounds end when the marginals agree with the targets within ``TOLERANCE``, or after
``MAX_ROUNDS``: targets that contradict one another are then missed by an error that is warned of.

A cell's probability is c times its fitted over its present tokens, 1 at most.  c is such that ``tokens`` are expected, or
the share ``keep`` of all: so what is kept of the corpus is set by the caller alone, not by the rarest cell.  A cell that would
need more than all its documents is taken whole and falls short of its target; no document is repeated; all other
cells stand to one another as fitted.  A document is taken if the hash of its key and ``seed`` falls under its
probability: a choice depends on nothing but the key, the seed and the cell.

Targets are shares: ``{value: share}``, or the present shares to the power ``TEMPER`` (1: as they are, 0: all
equal), which lifts small sources, languages and topics.  Powers of each margin by itself may contradict one
another (if sources determine languages); with ``joint`` the power is taken of the cells, and the targets are
the margins of that one table, which can always be met together.

Results for special inputs: null sources are one source, null languages one language, null and unlisted topics the
place of all others; null and empty texts have no tokens and get the probability of their cell, 0 if
the cell has no tokens at all, unless no cell has; rows with a null key share one draw, as do repeated
rows; an empty table gives an empty result; an input column with the name of an output column is replaced.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, quoted, without, written

MAX_LANGUAGES = 4096
KEEP = 0.9  # share of the tokens that is taken
TOPICS = ("legal", "contact", "table", "list")
TEMPER = 0.9
TOLERANCE = 1e-7
MAX_ROUNDS = 200
SEED = 11
OUTPUTS = ("topic", "n_tokens", "weight", "probability", "selected")


def surface_topic(text: Column) -> Column:
    """A topic from the looks of a text: licence lines, addresses, tables, lists, else prose."""
    t = F.coalesce(text, F.lit(""))

    def any_of(*parts):
        out = t.contains(parts[0])
        for p in parts[1:]:
            out = out | t.contains(p)
        return out

    return (F.when(any_of("icense", "ICENSE", "opyright", "COPYRIGHT", "ights reserved"), "legal")
            .when(any_of("://") | (t.contains("@") & t.rlike(r"\w@\w[\w-]*\.\w")) | (t.contains("+") & t.rlike(r"\+\d[\d ()-]{7}")), "contact")
            .when(any_of(" | "), "table").when(any_of("\n- ", "\n* "), "list").otherwise("prose"))


def place_in(column: Column, values) -> Column:
    """Number of the value in the list, the list's length for all others and null."""
    at = F.array_position(F.lit(list(values)).cast("array<string>"), column.cast("string")).cast("int") - 1 if values else F.lit(-1)
    return F.when(at >= 0, at).otherwise(F.lit(len(values)))


def languages_of(facts: DataFrame) -> list[str]:
    """The languages of (_l, n) by tokens, most first; null is none."""
    rows = (facts.where("_l IS NOT NULL").groupBy("_l").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "_l")
            .limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: not a column of language codes")
    return [r["_l"] for r in rows]


def in_order(given: dict | None, values) -> list[float] | None:
    """Shares by value in the order of ``values``, then that of all others (key None)."""
    if given is None:
        return None
    unknown = set(given) - {*values, None}
    if any(given[v] for v in unknown):
        raise ValueError(f"shares of values that are not there: {sorted(unknown)}")
    return [float(given.get(v, 0.0)) for v in [*values, None]]


def rake(sources: DataFrame, languages: int, topics: int, source_shares=None, language_shares=None, topic_shares=None,
         temper: float = TEMPER, joint: bool = False):
    """Factors of a cell table.  ``sources``: (source, m), ``m`` the tokens per language and topic as an array
    of languages * topics numbers.  Returns (expression of a source's factor, language factors,
    topic factors, rounds, error): the fitted weight of a cell is its tokens times the three; the error is
    the greatest difference of a language's or topic's fitted from its target share."""
    import numpy as np
    cells = languages * topics

    def summed(weight, m="m"):
        parts = sources.select(F.posexplode(F.transform(m, lambda n: n * weight)).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n"))
        out = np.zeros(cells)
        for r in parts.collect():  # languages times topics numbers
            out[r["i"]] = r["n"] or 0.0
        return out.reshape(languages, topics)

    def tempered(x):
        return np.where(x > 0, np.maximum(x, 1e-300) ** temper, 0.0)

    def shares(given, present, lifted):
        out = np.where(present > 0, lifted if given is None else np.array(given, dtype=np.float64), 0.0)
        return out / max(out.sum(), 1e-300)

    now = summed(F.lit(1.0))
    total = now.sum()
    power = F.transform("m", lambda n: F.when(n > 0, F.pow(n, F.lit(temper))).otherwise(0.0))
    lifted = summed(F.lit(1.0), power) if joint else None
    language, topic = (shares(given, now.sum(axis=axis), lifted.sum(axis=axis) if joint else tempered(now.sum(axis=axis)))
                       for given, axis in ((language_shares, 1), (topic_shares, 0)))
    own = F.aggregate("m", F.lit(0.0), lambda a, x: a + x)
    if source_shares is None:
        whole = F.aggregate(power, F.lit(0.0), lambda a, x: a + x) if joint else F.pow(own, F.lit(temper))
        goal = F.when(own > 0, whole).otherwise(0.0)
    else:
        goal = F.lit(0.0)
        for v, share in source_shares.items():
            goal = F.when(F.col("source") == v, F.lit(float(share))).otherwise(goal)
        goal = F.when(own > 0, goal).otherwise(0.0)
    whole = sources.agg(F.sum(goal)).first()[0] or 1.0
    goal = goal / F.lit(float(whole))
    a, b = np.ones(languages), np.ones(topics)
    factor, error = F.lit(1.0), 0.0
    for done in range(1, MAX_ROUNDS + 1):
        ab = F.lit([float(x) for x in np.outer(a, b).ravel()])
        fitted = F.aggregate(F.zip_with("m", ab, lambda n, f: n * f), F.lit(0.0), lambda s, x: s + x)
        factor = F.when(fitted > 0, goal / fitted).otherwise(0.0)
        matrix = summed(factor)  # tokens times source factor, by language and topic
        before = matrix * np.outer(a, b)
        error = max(np.abs(before.sum(axis=1) - language).max(), np.abs(before.sum(axis=0) - topic).max())
        if error < TOLERANCE or total == 0:
            error = error if total else 0.0
            break
        if done == MAX_ROUNDS:  # factors stay those that the error was taken of
            break
        rows = matrix @ b
        a = np.where(rows > 0, language / np.where(rows > 0, rows, 1), 0.0)
        columns = a @ matrix
        b = np.where(columns > 0, topic / np.where(columns > 0, columns, 1), 0.0)
    if error >= TOLERANCE:
        warnings.warn(f"targets of source, language and topic are missed by up to {error:.3g} after {done} rounds: they "
                      "contradict one another or converge slowly", RuntimeWarning, stacklevel=2)
    return factor, a, b, done, error


def scale_for(fitted: DataFrame, budget: float, steps: int = 64, passes: int = 4) -> float:
    """c for which the cells (m, ratio) give the sum of m * min(c * ratio, 1) as ``budget``, found by narrowing a range of
    c, one aggregation a pass.  Infinite if all that can be taken is less."""
    import numpy as np
    pairs = fitted.select(F.explode(F.arrays_zip("m", "ratio")).alias("x")).select("x.m", "x.ratio").where("m > 0 AND ratio > 0")
    end = pairs.agg(F.min("ratio").alias("lo"), F.max("ratio").alias("hi"), F.sum("m").alias("n")).first()
    if end["n"] is None or end["n"] <= budget:
        return float("inf")
    lo, hi = budget / end["n"] / end["hi"], 1 / end["lo"]  # at lo no more than the budget is taken, at hi all
    for _ in range(passes):
        grid = np.exp(np.linspace(np.log(lo), np.log(hi), steps))
        taken = pairs.agg(*[F.sum(F.col("m") * F.least(F.col("ratio") * F.lit(float(c)), F.lit(1.0))).alias(f"t{i}") for i, c in enumerate(grid)]).first()
        at = int(np.searchsorted(np.maximum.accumulate(np.array(taken, dtype=float)), budget))
        lo, hi = float(grid[max(at - 1, 0)]), float(grid[min(at, steps - 1)])
    return hi if hi == lo else lo + (hi - lo) / 2


def mix_sources(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", language: str = "lang",
                topic: Column | None = None, topics=TOPICS, source_shares: dict | None = None,
                language_shares: dict | None = None, topic_shares: dict | None = None, temper: float = TEMPER,
                keep: float = KEEP, tokens: float | None = None, seed: int = SEED, joint: bool = False) -> DataFrame:
    """``docs`` with topic, n_tokens, weight (the fitted share of its tokens), probability and selected.  In ``language_shares``
    and ``topic_shares`` the key None stands for null or all others."""
    columns = without(docs, OUTPUTS)
    kind = surface_topic(quoted(text)) if topic is None else topic
    count = F.coalesce(F.regexp_count(quoted(text), F.lit(WORD)), F.lit(0)).cast("long")
    facts = docs.select(quoted(source).alias("source"), quoted(language).cast("string").alias("_l"), kind.alias("_t"), count.alias("n"))
    facts = written(facts.groupBy("source", "_l", "_t").agg(F.sum("n").cast("double").alias("n")), "cells")
    languages = languages_of(facts)
    nl, nt = len(languages) + 1, len(topics) + 1
    cell = place_in(F.col("_l"), languages) * nt + place_in(F.col("_t"), topics)
    cells = facts.groupBy("source", cell.alias("c")).agg(F.sum("n").alias("n"))
    by_cell = F.map_from_entries(F.collect_list(F.struct("c", "n")))  # languages times topics at most
    table = written(cells.groupBy("source").agg(by_cell.alias("by")).select("source", F.transform(
        F.sequence(F.lit(0), F.lit(nl * nt - 1)), lambda i: F.coalesce(F.try_element_at("by", i), F.lit(0.0))).alias("m")), "cells")
    factor, a, b, _, _ = rake(table, nl, nt, source_shares, in_order(language_shares, languages), in_order(topic_shares, topics), temper, joint)
    ab = F.lit([float(x * y) for x in a for y in b])
    fitted = table.select("source", "m", F.transform(ab, lambda f: f * factor).alias("ratio"))  # weight per token, by cell
    total = table.agg(F.sum(F.aggregate("m", F.lit(0.0), lambda s, x: s + x))).first()[0] or 0.0
    scale = scale_for(fitted, keep * total if tokens is None else tokens) if total else 0.0
    rows = docs.select(*[quoted(c) for c in columns], kind.alias("topic"), count.alias("n_tokens"),
                       (place_in(quoted(language), languages) * nt + place_in(kind, topics)).alias("_c"), quoted(source).alias("_source"))
    # the ratio table has one row per source; Spark broadcasts it only if it measures it small
    side = fitted.select(F.col("source").alias("_s"), "ratio")
    ratio = F.get("ratio", F.col("_c"))
    if not total:
        chance = F.lit(1.0)
    elif scale == float("inf"):
        chance = F.when(ratio > 0, 1.0).otherwise(0.0)
    else:
        chance = F.least(ratio * F.lit(scale), F.lit(1.0))
    draw = F.pmod(F.xxhash64(quoted(key).cast("string"), F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (rows.join(side, F.col("_source").eqNullSafe(F.col("_s")))
            .select(*[quoted(c) for c in columns], "topic", "n_tokens", (ratio * F.col("n_tokens")).alias("weight"),
                    chance.alias("probability"), (draw < chance).alias("selected")))
