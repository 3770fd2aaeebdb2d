"""Phrases against plain counting and DuckDB; summaries against their guarantee."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle_check import compare, duck
from textprice.llm import phrases as ph


def plain(docs, least, top=2000):
    f, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i:i + k]))
                    f[key] = f.get(key, 0) + 1
    rows = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        longer = [b for (g, q), b in f.items() if g == lang and len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and b >= least]
        if any(100 * b >= 50 * a for b in longer):
            continue
        rows.append((lang, " ".join(p), a, left, right, n[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(out)


def drawn(seed, n=200):
    rng = random.Random(seed)
    words = ["new", "York", "CITY", "of", "the", "état", "北京", "a b", "x"] + [f"w{i}" for i in range(30)]
    weights = [8] * 9 + [1] * 30
    return [(rng.choice(["en", "fr", None, "und", ""]), "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "])
             for w in rng.choices(words, weights, k=rng.randint(0, 60)))) for _ in range(n)] + [("en", None), (None, ""), ("en", " .,. \n")]


@pytest.mark.parametrize("least,top", [(10, 2000), (3, 7), (2, 2000)])
def test_equals_plain_counting(spark, least, top):
    docs = drawn(least)
    df = spark.createDataFrame([(*d, "x") for d in docs], "lang string, text string, phrase string").repartition(4)
    got = ph.mine_phrases(df, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(docs, least, top)


@pytest.mark.parametrize("limit", [1, 2, 7, 100000])
def test_blocks_end_anywhere(limit):
    text = [(t or "").encode() for _, t in drawn(9, 40)]
    langs = np.arange(len(text)) % 3
    numbered = ph.word_numbers(text, langs)
    want, got, mass = Counter(), Counter(), 0
    for lang, t in zip(langs, text, strict=True):
        for piece in re.split(b"[.,;:!?\n\x0b\x0c\r]", t.lower()):
            w = re.findall(b"[^ \t]+", piece)
            want.update((f"l{lang}", b" ".join(w[i:i + k]).decode()) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for row in ph.block_rows(*numbered, ["l0", "l1", "l2"], limit):
        block = ph.Block(row)
        mass += row["mass"]
        assert (block.hashes[1:] >= block.hashes[:-1]).all()
        assert block.counts.sum() == row["mass"]
        lang, phrase, size = block.phrases(np.ones(len(block.keys), dtype=bool))
        for g, p, k, c in zip(lang.to_pylist(), phrase.to_pylist(), size, block.counts, strict=True):
            assert k == len(p.split(" "))
            got[g, p] += int(c)
    assert got == want
    assert mass == sum(want.values())


def test_a_block_is_built_in_a_small_multiple_of_its_sequences():
    """Memory of a block while it is built: 80 bytes a sequence before, under 50 now."""
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 50000, 300000)).encode()
    (row,) = ph.block_rows(*ph.word_numbers([text], [0]), ["en"], ph.BLOCK_WORDS)
    tracemalloc.start()
    try:
        block = ph.Block(row)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(block.keys) > 600000
    assert peak < 60 * len(block.keys)


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(7)
    for capacity in (20, 100, 700):
        stream = np.concatenate((rng.integers(0, 3000, 6000), np.repeat(rng.integers(0, 3000, 40), 30))).astype(np.uint32)
        rng.shuffle(stream)
        keys, counts = np.unique(stream, return_counts=True)
        parts = np.array_split(stream, 13)
        one, others = ph.Summary(capacity), []
        for i, part in enumerate(parts):
            k, c = np.unique(part, return_counts=True)
            if i % 2:
                other = ph.Summary(capacity)
                other.merge(k, c)
                others.append(other)
            else:
                one.merge(k, c)
        for other in others:
            one.merge(other.keys, other.counts, other.taken)
        assert len(one.keys) <= capacity
        assert one.taken <= len(stream) / (capacity + 1)
        held = dict(zip(one.keys.tolist(), one.counts.tolist(), strict=True))
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            assert c - one.taken <= held.get(k, 0) <= c
        for least in (5, 20, 40):
            if one.taken < least:
                assert set(keys[counts >= least].tolist()) <= set(one.survivors(least).tolist())


def test_long_text_null_and_empty(spark):
    schema = "lang string, text string"
    assert ph.mine_phrases(spark.createDataFrame([], schema)).count() == 0
    assert ph.mine_phrases(spark.createDataFrame([(None, None)], schema)).count() == 0
    long = "one two three, " * 300000  # over a slice
    got = sorted(map(tuple, ph.mine_phrases(spark.createDataFrame([("en", long)], schema)).collect()))
    assert got == [("en", 1, "one two three", 300000, 300000, 300000, 900000, 1000000)]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query_equals_sql(spark, sf):
    df = entry.queries()["op12_phrases"](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(sf).execute(entry.oracle_sql()["op12_phrases"])
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
