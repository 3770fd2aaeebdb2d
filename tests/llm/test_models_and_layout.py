"""Packing, URL filter, mixing, language model, quality classifier and vector search."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textprice.llm import maxent_lm, mixing, one_bit_search, packing, quality, url_filter
from textprice.llm.queries import QUERIES, TOKENIZER, URL_RULES

from ..conftest import SF_ORACLE, SF_SMALL
from .test_text_operators import corpus, frame


def test_fullest_is_the_best_fill():
    rng = random.Random(2)
    for _ in range(200):
        items = [rng.randrange(1, 20) for _ in range(rng.randrange(0, 9))]
        room = rng.randrange(0, 40)
        counts = np.bincount(items, minlength=41)
        used = packing.fullest(room, counts, sorted(set(items), reverse=True))
        best = max(sum(c) for n in range(len(items) + 1) for c in itertools.combinations(items, n) if sum(c) <= room)
        assert sum(n * m for n, m in used.items()) == best
        assert all(m <= counts[n] for n, m in used.items())


def test_minimum_bin_slack_uses_all_pieces():
    rng = random.Random(3)
    counts = np.zeros(101, dtype=np.int64)
    for _ in range(3000):
        counts[min(100, int(rng.expovariate(0.05)) + 1)] += 1
    patterns = packing.minimum_bin_slack(counts, 100)
    used, bins = np.zeros(101, dtype=np.int64), 0
    for p, n in patterns:
        assert sum(a * b for a, b in p.items()) <= 100
        bins += n
        for length, times in p.items():
            used[length] += times * n
    assert (used == counts).all()
    assert bins <= -(-int((counts * np.arange(101)).sum()) // 100) + 1


def check_packing(rows, texts, capacity, end_id=1):
    tokenizer = packing.load_tokenizer(TOKENIZER)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id] for i, t in enumerate(texts)}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [
            (k, at, min(capacity, len(ids[i]) - at)) for k, at in enumerate(range(0, len(ids[i]), capacity))]
        for r in own:
            part = np.array(ids[i][r["start"]:r["start"] + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), sum(len(x) for x in ids.values())


def test_packing_round_trip(spark):
    texts = corpus(3) + ["<|endoftext|> I'm <|startoftext|>x", "ÀÉ é ́x don't 12 3", "A B C\x1cD"]
    docs = frame(spark, texts).withColumn("piece", F.lit("clash"))
    rows = packing.best_fit_packing(docs, TOKENIZER, capacity=200).collect()
    n, total = check_packing(rows, texts, 200)
    assert n <= -(-total // 200) + 1
    assert packing.best_fit_packing(frame(spark, []), TOKENIZER).count() == 0


def test_packing_query_round_trip(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    n, total = check_packing(QUERIES["op3_best_fit_packing"](spark, SF_SMALL).collect(), texts, packing.CAPACITY)
    assert n <= -(-total // packing.CAPACITY) + 1


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filter.build_cascade(keys, bits_per_key=4, shard_keys=500)
    assert len(cascade.words) > 2 and cascade.shards > 1
    assert cascade.mark(keys, F.col("key"), "found").where("found <> listed").count() == 0
    for listed in ("true", "false"):
        some = keys.withColumn("listed", F.expr(listed)).limit(50)
        assert url_filter.build_cascade(some).mark(some, F.col("key"), "f").where(f"f <> {listed}").count() == 0


def test_urls_and_rules(spark):
    cases = [(None, "", "", None, "allow"), ("no scheme.org/es/", "", "", None, "allow"), ("", "", "", None, "allow"),
             ("http://X.Example.ORG/es/1?q#f", "x.example.org", "/es/1", "example.org/es/", "block"),
             ("http://example.org/en/19", "example.org", "/en/19", "example.org/en/1", "block"),
             ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
             ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
             ("http://a.org", "a.org", "", None, "allow"), ("http://a.org?x=/", "a.org", "", None, "allow"),
             ("http://com/de/", "com", "/de/", "com/de/", "block"), ("http://a.com/DE/1", "a.com", "/DE/1", None, "allow"),
             ("https://a.com/fr/#x", "a.com", "/fr/", "com/fr/", "allow"), ("http://a.net/http://b.org/es/", "a.net", "/http://b.org/es/", None, "allow"),
             ("https://b.com/de/7.html", "b.com", "/de/7.html", "com/de/", "block"), ("https://b.com/DE/7/", "b.com", "/DE/7/", None, "block"),
             ("x\ny://ÉA.com/p", "Éa.com", "/p", None, "allow")]
    pages = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases * 2)], "page_id long, url string, host string")
    rows = {r["page_id"]: r for r in url_filter.filter_urls(pages, URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases * 2):
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) == (host, path, rule, verdict), cases[i % len(cases)]
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).count() == 0


def mixed_docs(spark, n=600):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)) + rng.choice(["", "", " | x", " copyright"]),
             rng.choices(["en", "de", None, "xx"], [6, 2, 1, 1])[0], rng.choices(["a", "b", "c", None], [20, 3, 2, 1])[0], "clash")
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight string")


def test_raked_weights_match_direct_fitting(spark):
    out = [r.asDict() for r in mixing.mix_sources(mixed_docs(spark)).collect()]
    assert len(out) == 600
    cell = {}
    for r in out:
        r["l"] = r["lang"]
        r["t"] = r["topic"] if r["topic"] in mixing.TOPICS else "other"
        key = (r["source"], r["l"], r["t"])
        cell[key] = cell.get(key, 0) + r["n_tokens"]
    cell = {k: v for k, v in cell.items() if v}
    fitted = dict(cell)

    def marginal(values, i):
        total = {}
        for k, v in values.items():
            total[k[i]] = total.get(k[i], 0) + v
        return total

    goals = []
    for i in range(3):
        m = {k: v ** mixing.TEMPER for k, v in marginal(cell, i).items()}
        goals.append({k: v / sum(m.values()) for k, v in m.items()})
    for _ in range(2000):
        for i in range(3):
            m = marginal(fitted, i)
            fitted = {k: v * goals[i][k[i]] / m[k[i]] for k, v in fitted.items()}
    for i in range(3):
        got = {}
        for r in out:
            k = (r["source"], r["l"], r["t"])[i]
            got[k] = got.get(k, 0) + r["weight"]
        assert all(abs(got[k] - goals[i][k]) < 1e-6 for k in goals[i])
    assert abs(sum(r["probability"] * r["n_tokens"] for r in out) / sum(cell.values()) - mixing.KEEP) < 1e-4
    open_ = [(r["probability"] / (fitted[k] / cell[k])) for r in out for k in [(r["source"], r["l"], r["t"])] if k in cell and r["probability"] < 1]
    assert max(open_) / min(open_) < 1 + 1e-5  # in proportion to the fitted weights
    for r in out:  # whole cells are those that would need more
        k = (r["source"], r["l"], r["t"])
        if k in cell and r["probability"] == 1:
            assert fitted[k] / cell[k] * open_[0] > 1 - 1e-4
    assert len({r["l"] for r in out}) == 4
    taken = sum(r["selected"] for r in out)
    assert abs(taken - sum(r["probability"] for r in out)) < 60


def test_mixing_to_given_shares_and_edges(spark):
    docs = mixed_docs(spark)
    shares = {"a": 0.2, "b": 0.5, "c": 0.3}
    out = mixing.mix_sources(docs, source_shares=shares, language_shares={"en": 0.5, "de": 0.3, None: 0.2}, tokens=500).collect()
    got = {}
    for r in out:
        got[r["source"]] = got.get(r["source"], 0) + r["weight"]
    assert all(abs(got[k] - v) < 1e-6 for k, v in shares.items()) and got[None] == 0
    assert abs(sum(r["probability"] * r["n_tokens"] for r in out) - 500) < 0.1
    with pytest.raises(ValueError, match="not there"):
        mixing.mix_sources(docs, language_shares={"zz": 1.0})
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert mixing.mix_sources(blank).where("selected AND n_tokens = 0").count() == 600


def test_language_model_is_a_distribution_and_base_is_exact(spark):
    """The probabilities of all V + 1 tokens in any context add up to 1."""
    texts = ["The cat sat.", "the dog sat.", "A the the of x1 x2 x3", None, "", "the the the"]
    docs = frame(spark, texts * 4).withColumn("train", F.col("doc_id") % 6 != 5)
    rows = {r["doc_id"]: r for r in maxent_lm.score_language_model(docs.withColumn("score", F.lit("clash"))).collect()}
    train = [w for i, t in enumerate(texts * 4) if i % 6 != 5 for w in [*(t or "").lower().split(), "\0"]]
    n, v = len(train), len(set(train))
    for i, t in enumerate(texts * 4):
        toks = [*(t or "").lower().split(), "\0"]
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(toks), sum(w in train for w in toks), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((train.count(w) + 0.5) / (n + 0.5 * (v + 1))) for w in toks))
        assert r["score"] < 0
    # every single known word, and an unknown one, after the start of a text
    words = sorted(set(train) - {"\0"})
    probe = [(1000 + i, w, False) for i, w in enumerate([*words, "never-seen"])]
    both = spark.createDataFrame([(i, t, i % 6 != 5) for i, t in enumerate(texts * 4)] + probe, "doc_id long, text string, train boolean")
    scored = {r["text"]: r for r in maxent_lm.score_language_model(both).collect() if r["doc_id"] >= 1000}
    ends = {r["doc_id"]: r for r in maxent_lm.score_language_model(both).collect()}
    assert scored["never-seen"]["n_known"] == 1 and len(ends) == len(probe) + 24
    assert maxent_lm.score_language_model(both.limit(0)).count() == 0


def test_class_softmax_and_shares_sum_to_one():
    rng = np.random.default_rng(1)
    w = rng.normal(size=(1 + maxent_lm.FEATURES * maxent_lm.HASHED, maxent_lm.CLASSES)).astype(np.float32)
    h, lens = maxent_lm.tokens(["a b c", "", "a a"])
    z = maxent_lm.logits(w, maxent_lm.context_rows(h, lens))
    assert lens.tolist() == [4, 1, 3] and (h[[3, 4, 7]] == 0).all()
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose((p / p.sum(axis=1, keepdims=True)).sum(axis=1), 1)
    assert maxent_lm.band_of(np.array([-1, 0, 1, 2, 3, 4, 1 << 40])).tolist() == [
        maxent_lm.UNSEEN, maxent_lm.UNSEEN, *[maxent_lm.TOP + 1 + b for b in (0, 1, 1, 2, maxent_lm.BANDS - 1)]]


def test_gradient_steps_learn_a_rule():
    """Class 1 follows context 5, class 2 follows context 6."""
    rng = np.random.default_rng(2)
    w = np.zeros((1 + maxent_lm.FEATURES * maxent_lm.HASHED, maxent_lm.CLASSES), dtype=np.float32)
    squares = np.zeros_like(w)
    for _ in range(60):
        which = rng.integers(0, 2, 256)
        rows = np.stack([5 + which] + [rng.integers(100, 200, 256) + f * maxent_lm.HASHED for f in (1, 2)], axis=1)
        maxent_lm.step(w, squares, rows, 1 + which)
    z = maxent_lm.logits(w, np.array([[5, 2100, 4200], [6, 2100, 4200]]))
    assert z.argmax(axis=1).tolist() == [1, 2]


def test_language_model_beats_its_base_on_held_out_texts(spark):
    rows = [r for r in QUERIES["op7_maxent_lm"](spark, SF_ORACLE).collect() if r["held_out"]]
    assert len(rows) > 100
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_quality_on_held_out_labels(spark):
    out = QUERIES["op9_quality_classifier"](spark, SF_ORACLE)
    told = out.join(spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in told]) >= 0.9
    bad = [r["score"] for r in told if r["quality"] == 0]
    good = [r["score"] for r in told if r["quality"] == 1]
    assert np.mean([b < g for b in bad for g in good]) >= 0.95


def plain_ftrl(examples, epochs):
    """FTRL-proximal logistic regression, a coordinate at a time; examples: ({index: value}, label)."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return (sign * quality.L1 - z[i]) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for x, y in examples:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - y) * x[i]
                step = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / quality.ALPHA
                z[i], n[i] = z.get(i, 0.0) + g - step * w[i], n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_quality_equals_plain_ftrl(spark):
    """Weights and scores against a learner of single coordinates, on texts that keep hashed features apart."""
    texts = corpus(6)
    labels = [(i, i % 3 % 2) for i in range(0, len(texts), 2)]
    docs = frame(spark, texts)
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    weights = quality.train(docs, told)
    bits = (len(weights) - 1).bit_length() - 1
    order = {r["k"]: n for n, r in enumerate(told.selectExpr("doc_id AS k").withColumn("h", F.xxhash64("k", F.lit(17))).orderBy("h").collect())}

    def example(text):
        words = (text or "").encode().split()
        found, _, _ = quality.features([text or ""], bits)
        x = {}
        for i in found.ravel().tolist():
            x[i] = x.get(i, 0) + 1
        return {**{i: float(np.float32(quality.SCALE * c / max(1, len(words)))) for i, c in x.items()}, len(weights) - 1: 1.0}

    examples = [(example(texts[i]), y) for i, y in sorted(labels, key=lambda e: order[e[0]])]
    want = plain_ftrl(examples, quality.EPOCHS)
    assert set(np.flatnonzero(weights)) == {i for i, w in want.items() if w}
    assert max(abs(weights[i] - w) for i, w in want.items()) < 1e-8
    for r in quality.score(docs, weights).collect():
        s = sum(want.get(i, 0.0) * v for i, v in example(texts[r["doc_id"]]).items())
        assert abs(r["score"] - 1 / (1 + np.exp(-s))) < 1e-5


def test_quality_edges(spark):
    assert quality.form_of("Thhaen THE!! é9 ond###".encode()) == b"Aa A! a9 a#"
    texts = corpus(5)
    docs = frame(spark, texts).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (99_999, 1), (None, 1), (3, None)], "doc_id long, quality int")
    weights = quality.train(docs, labels)
    rows = quality.score(docs, weights).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").split()}) == 1
    none = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), none).count() == 0


def test_search_matches_brute_force_with_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 48))
    x[300:420] = x[300]  # a large group of equal vectors
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(900, None), (1000, [0.0] * 48), (1001, [float("nan")] + [1.0] * 47), (1002, [None] + [1.0] * 47), (1100, [1.0, 2.0]),
             (1101, [1.0, 2.5]), (1200, [float("inf")] * 48), (None, [1.0] * 48), (300, [float(c) for c in x[5]])]
    vectors = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(4)
    usable = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
              if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    want = []
    for row, (q, a) in enumerate(usable):
        if q % 100 == 0:
            near = sorted((float(one_bit_search.distances(b[None], a)[0]), i) for n, (i, b) in enumerate(usable)
                          if n != row and len(a) == len(b))[:10]
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    got = [tuple(r) for r in one_bit_search.nearest(vectors, F.col("id") % 100 == 0, block=3).collect()]
    assert len(got) == len(want)
    assert len(set(got) & set(want)) >= 0.97 * len(set(want))
    assert {r[2] for r in got if r[0] == 300} & {5, 300}  # rows of a repeated id find what is near them, each other too
    assert [r for r in got if r[0] == 1100] == [(1100, 1, 1101, 0.5)]
    assert one_bit_search.nearest(vectors.limit(0), F.col("id") % 100 == 0).count() == 0


def test_search_recall_of_the_query(spark):
    from ..oracle_check import duck
    from textprice.llm.queries import NEAREST_SQL
    want = {(r[0], r[2]) for r in duck("/root/testdata/sf0.1").execute(NEAREST_SQL).fetchall()}
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["op10_one_bit_search"](spark, "/root/testdata/sf0.1").collect()}
    assert len(got & want) >= 0.98 * len(want)


def test_words_of_a_class_depend_on_the_context(spark):
    """Words of one count, of which half follow one word and half another: each is likelier where it belongs.  With a
    word's share of its class for its probability they were alike."""
    texts = [f"{a} {b}{i}" for i in range(60) for a, b in (("left", "x"), ("right", "y"))] * 9 + [f"n{i}" for i in range(45)] * 50
    probe = [f"left {b}{i}" for b in "xy" for i in range(60)]
    docs = spark.createDataFrame([(t, True) for t in texts] + [(t, False) for t in probe], "text string, train boolean")
    p = {r["text"]: r["score"] for r in maxent_lm.score_language_model(docs).where("NOT train").collect()}
    gain = np.array([p[f"left x{i}"] - p[f"left y{i}"] for i in range(60)])
    assert gain.mean() > 0.3 and np.mean(gain > 0) > 0.8


def test_ways_to_words_are_a_distribution():
    """Any weights: over all words of a class, the products along their ways add up to 1."""
    rng = np.random.default_rng(4)
    per = np.zeros((3, maxent_lm.CELLS), dtype=np.int64)
    counts = {0: 1, 8: 2, 12: 3, 25: 9, 31: 15}  # cell: a count in it
    for cell, n in zip(counts, ((200, 3, 400), (1, 0, 0), (5, 6, 7), (4, 4, 9), (0, 1, 0)), strict=True):
        assert maxent_lm.cell_of(np.array([counts[cell]]))[0] == cell
        per[:, cell] = n
    mass = [counts.get(c, 0) for c in range(maxent_lm.CELLS)] * per
    top = [{"bucket": 0, "n": 9, "rank": 1}, {"bucket": 2, "n": 9, "rank": 8}, {"bucket": 1, "n": 15, "rank": 0}]
    v = maxent_lm.Vocabulary.__new__(maxent_lm.Vocabulary)
    v.number_words([{"bucket": b, "cells": per[b].tolist(), "mass": mass[b]} for b in range(3)], top, 3)
    words = [(counts[c], b, r) for c in counts for b in range(3) for r in range(per[b, c])
             if not any((t["n"], t["bucket"], t["rank"]) == (counts[c], b, r) for t in top)]
    n = np.array([w[0] for w in words])
    numbers = np.array([v.numbers(np.array([c]), b, np.array([r]))[0] for c, b, r in words])
    kind = maxent_lm.band_of(n)
    path = v.paths(kind, n, numbers)
    w = rng.normal(size=((1 + maxent_lm.FEATURES) * maxent_lm.WORD_ROWS, maxent_lm.FAN)).astype(np.float32)
    hashes = [np.full(len(n), x, dtype=np.uint64) for x in (5, 6, 7)]  # one context for all
    some = np.flatnonzero(path[0] > 0)
    rows, child, prior, lens = maxent_lm.word_rows(path, np.arange(len(n)), hashes, some)
    taken = maxent_lm.log_share(maxent_lm.added(w, rows, v.prior.take(prior, axis=0)), child)
    p = np.ones(len(n))
    p[some] = np.exp(np.add.reduceat(taken, maxent_lm.starts(lens)))
    for k in np.unique(kind):
        assert p[kind == k].sum() == pytest.approx(1, abs=1e-4)
    zero = maxent_lm.log_share(maxent_lm.added(np.zeros_like(w), rows, v.prior.take(prior, axis=0)), child)  # untrained: shares of the tokens
    p[some] = np.exp(np.add.reduceat(zero, maxent_lm.starts(lens)))
    assert np.allclose(p, n / np.bincount(kind, n)[kind], rtol=1e-4)
