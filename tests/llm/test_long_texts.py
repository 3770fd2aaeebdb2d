"""Texts longer than a chunk (2 MB) and than a slice, beside short ones, in the operators on words."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textprice.llm import common, maxent_lm, near_dedup, packing, quality, substring_dedup
from textprice.llm.queries import TOKENIZER

WORDS = 420_000


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(5000)]
    long = rng.choices(vocabulary, k=WORDS)
    other = [*long[:200_000], "changed", *long[200_001:]]
    out = [" ".join(long), " ".join(other), " ".join(long[1000:1080]), None, ""]
    assert len(out[0]) > common.CHUNK_BYTES
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()


def test_substring_dedup(docs, texts):
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(docs).collect()}
    words = [(t or "").split() for t in texts]
    assert [got[i]["n_words"] for i in range(5)] == [len(w) for w in words]
    # the third text stands in both long ones whole; these differ in one word, of which 35 windows are left
    assert got[2]["n_removed"] == 80 and got[0]["n_removed"] == WORDS - 1 and got[1]["n_removed"] == WORDS - 1
    assert got[1]["kept_text"] == "changed" and got[0]["kept_text"] == words[0][200_000]


def test_near_duplicates(docs):
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs, rows=False).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


def test_packing(docs, texts):
    rows = packing.best_fit_packing(docs, TOKENIZER).collect()
    tokenizer = packing.load_tokenizer(TOKENIZER)
    for i in (0, 2, 3):
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        own = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert sum(n for _, _, n in own) == len(ids) and [s for _, s, _ in own] == [4096 * k for k in range(len(own))]
        assert all(n == 4096 for _, _, n in own[:-1])
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        assert sum(n for _, n in p) <= 4096 and all(a + n == b for (a, n), (b, _) in zip(sorted(p), sorted(p)[1:], strict=False))


def test_language_model_base(docs, texts):
    got = {r["doc_id"]: r for r in maxent_lm.score_language_model(docs.withColumn("train", F.col("doc_id") != 1)).collect()}
    train = [w for i, t in enumerate(texts) if i != 1 for w in [*(t or "").split(), "\0"]]
    n = len(train)
    counts = {}
    for w in train:
        counts[w] = counts.get(w, 0) + 1
    tokens = [*texts[1].split(), "\0"]
    base = sum(np.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (len(counts) + 1))) for w in tokens)
    assert got[1]["train_tokens"] == n and got[1]["n_tokens"] == WORDS + 1
    assert got[1]["base_score"] == pytest.approx(base, rel=1e-9) and np.isfinite(got[1]["score"])


def test_quality_scores(spark, docs, texts):
    weights = quality.train(docs, spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int"))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, weights).collect()}
    bits = (len(weights) - 1).bit_length() - 1
    for i, t in enumerate(texts):
        found, _, lens = quality.features([t or ""], bits)
        s = weights[found].sum() * quality.SCALE / max(1, lens[0]) + weights[-1]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-s)), rel=1e-6)


def test_word_encoder_cuts_at_white_space_only_if_the_vocabulary_does():
    tokenizer = packing.load_tokenizer(TOKENIZER)
    assert packing.encodes_by_word(tokenizer)
    other = packing.load_tokenizer("byte_bpe_50k.json")  # its pieces take the space before a word in
    assert not packing.encodes_by_word(other)
    texts = ["two  words\n", "", "a b", "\u00e9t\u00e9 \u5317 x" * 3]
    for t in (tokenizer, other):
        flat, lens = packing.WordEncoder(t, 3).encode(texts)
        want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
        assert lens.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def test_sha_of_kept_words(docs):
    row = substring_dedup.substring_dedup(docs).where("doc_id = 1").select(F.sha2("kept_text", 256).alias("s")).first()
    assert row["s"] == hashlib.sha256(b"changed").hexdigest()
