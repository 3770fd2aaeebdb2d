"""Scored pipelines on large tables: what is read, written and kept; and that faster forms of helpers give the same."""

import glob
import os
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textprice.functions import text as tx
from textprice.operators import embedding as em
from textprice.plans import preprocessing as pp
from textprice.session import CLEANUP, ensure_checkpoint_dir, stored
from textprice.streaming import score


@pytest.fixture(scope="module")
def posts(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        text = " ".join(rng.choice(["alpha", "beta", "gamma.", "the", "Delta"]) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 20)))
        rows.append((i, "2024-01-01", text, "s", 1.0 + rng.random(), 2.0 + rng.random(), rng.random(), None if i % 50 == 7 else 1.5 + rng.random(), 1.5, 10.0 * rng.random()))
    return spark.createDataFrame(rows, score.POST_MESSAGE_SCHEMA).repartition(3).cache()


def scratch(spark, name):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return set(glob.glob(os.path.join(base, "textprice-scratch", f"{name}-*")))


def test_fitting_embeds_once_and_leaves_nothing_but_the_vectors(spark, posts, monkeypatch):
    before, seen, embed = {n: scratch(spark, n) for n in ("tokens", "features", "rows-to-embed")}, [], em.embed_tokens
    monkeypatch.setattr(em, "embed_tokens", lambda *a, **k: seen.append(1) or embed(*a, **k))
    model = pp.fit_full_model(posts, vector_size=8)
    assert seen == [1] and {n: scratch(spark, n) for n in before} == before
    assert spark.conf.get(CLEANUP, None) in (None, "false")
    size = len(em.rows_written())
    got = pp.score(posts, model, ["doc_id", "prediction"])
    assert got.columns == ["doc_id", "prediction"] and len(em.rows_written()) == size + 1
    assert "tweet" not in spark.read.parquet(em.rows_written()[-1]).columns  # texts are not dealt out
    whole = {r.doc_id: r.prediction for r in pp.score(posts, model).collect()}
    assert whole.keys() == {r.doc_id for r in got.collect()} and len(whole) == 400
    assert all(abs(r.prediction - whole[r.doc_id]) < 1e-9 for r in got.collect())


def test_assembling_embeds_no_first_row(spark, posts):
    """The embedding tells its length, so that nothing runs while the plan of the features is built."""
    tokens = posts.select("doc_id", F.split("tweet", " ").alias("tokens"))
    got = em.ShardedWord2Vec(vectorSize=6).fit(tokens).transform(tokens)
    assert got.schema["embedding"].metadata["ml_attr"]["num_attrs"] == 6


def test_stored_rows_are_read_back_and_deleted(spark):
    rows = [(1, ["a", None], None), (2, None, 2.5), (2, None, 2.5)]
    df = spark.createDataFrame(rows, "i int, w array<string>, x double")
    before = scratch(spark, "stored-test")
    with stored(df, "stored-test") as table:
        assert sorted(map(tuple, table.collect())) == rows and len(scratch(spark, "stored-test")) == len(before) + 1
    assert scratch(spark, "stored-test") == before


ODD = [["a", "b", "a"], [], None, [None], ["", None, ""], [""], ["x\x1fy", "\x1e", "\x1e0\x1f1"], ["\x1e3"], ["\x1e2", None]]


def test_joined_tokens_come_back(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t array<string>").coalesce(1)
    import pyarrow as pa
    texts = [r.j for r in df.select("i", em.joined("t").alias("j")).sort("i").collect()]
    lengths, numbers, words = em.separated(pa.array(texts, pa.string()))
    said, ends = [words[int(n)].as_py() for n in numbers], np.concatenate(([0], np.cumsum(lengths)))
    assert [None if t is None else said[a:b] for t, a, b in zip(texts, ends, ends[1:], strict=False)] == ODD
    model = em.ShardedWord2Vec(vectorSize=4, inputCol="t").fit(df)
    assert {r.word for r in model.getVectors().collect()} == {w for t in ODD for w in t or () if w is not None}
    assert [r.t for r in model.transform(df).sort("i").collect()] == ODD


def test_small_and_large_groups_give_the_same_vectors(spark, posts, monkeypatch):
    tokens = posts.select("doc_id", F.split("tweet", " ").alias("tokens"))
    model = em.ShardedWord2Vec(vectorSize=5).fit(tokens)
    seen = []
    for size in (200, 32 << 20):
        monkeypatch.setattr(em, "EMBED_BYTES", size)
        seen.append({r.doc_id: r.e for r in model.transform(tokens).select("doc_id", vector_to_array("embedding").alias("e")).collect()})
    assert seen[0].keys() == seen[1].keys() and len(seen[0]) == 400
    np.testing.assert_allclose([seen[0][i] for i in range(400)], [seen[1][i] for i in range(400)], atol=1e-12)


def test_training_in_strips_equals_all_pairs():
    def plain(rows, centre, context, window, rate, seed):
        rng, tokens = np.random.default_rng(seed), np.concatenate(rows)
        text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        noise = np.cumsum((p := np.bincount(tokens, minlength=len(centre)) ** 0.75) / p.sum())

        def add(table, places, change):
            for w in set(places.tolist()):
                total = change[places == w].sum(axis=0)
                table[w] += total * min(1, em.LONGEST / max(np.linalg.norm(total), 1e-12))

        step = em.RUN - window
        for n, at in enumerate(range(0, len(tokens), step)):
            run, own = tokens[at:at + em.RUN], text[at:at + em.RUN]
            near = np.arange(len(run))[None, :] - np.arange(len(run))[:, None]
            pairs = (own[:, None] == own[None, :]) & (near != 0) & (np.abs(near) <= window)
            if at:
                pairs[:window, :window] = False
            drawn = np.searchsorted(noise, rng.random(em.NEGATIVES)).clip(max=len(centre) - 1)
            v, u, w = centre[run].copy(), context[run].copy(), context[drawn].copy()
            now = rate * max(1 - n * step / len(tokens), 0.1)
            pull = now * pairs / (1 + np.exp(v @ u.T))
            push = now * pairs.sum(axis=1)[:, None] / em.NEGATIVES * 5 * (drawn[None, :] != run[:, None]) / (1 + np.exp(-(v @ w.T)))
            add(centre, run, pull @ u - push @ w)
            add(context, np.concatenate((run, drawn)), np.concatenate((pull.T @ v, -(push.T @ v))))

    rng = np.random.default_rng(5)
    for lengths, words, window in (([500, 3, 1, 260], 40, 5), ([7] * 90, 200, 2), ([300], 1, 5)):
        rows = [rng.integers(0, words, n) for n in lengths]
        start = ((rng.random((2, words, 12)) - 0.5) / 4).astype(np.float32)
        a, b = start.astype(np.float64), start.copy()
        plain(rows, a[0], a[1], window, 0.05, 9)
        em.train_group(rows, b[0], b[1], window, 0.05, 9)
        np.testing.assert_allclose(a, b, atol=2e-4)
        assert np.abs(a[0] - start[0]).max() > 1e-2 or words == 1


def test_a_wide_group_of_words_without_lists_is_not_slow(spark):
    """Word rows have no null lists: Spark's Arrow writer would go back over all of a batch's at every row."""
    rows = spark.createDataFrame([(0, "a b", [1.0])], "_group long, _tokens string, x array<double>")
    words = spark.createDataFrame([(0, "a"), (0, "b")], "_group long, word string")
    got = em.with_vectors(words, rows, None, False, 1)
    assert got.where("word IS NOT NULL AND x IS NULL").count() == 0 and got.where("x = array(1.0D)").count() == 1


def test_cleaner_finds_the_same_signs(spark):
    odd = [None, "", "A:x_y:B ht:smile_face:tp://x y", "www.a.b @x #y, $5%!", "plain, text.", "@me", "#t x", "a : b", "HTTP://Q z", "ht:a:tps x",
           "@@x##y::z_:", "a\U0001F600b\U0001F600\U0001F601 c", "été ’x　y z", "A-B_C\tD\nE\rF\x0bG\x0cH\x1cI\x85J.", "$%^&*()"]
    df = spark.createDataFrame([(t,) for t in odd + [f"x{chr(c)} {chr(c)}{chr(c)}" for c in range(1, 0x3000)]], "t string")
    slow = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower("t"), tx.EMOJI_ALIAS_PATTERN, ""), tx.URL_PATTERN, ""),
                                             tx.MENTION_PATTERN, ""), tx.PUNCT_PATTERN, "")
    for fast in (tx.clean_expr(F.col("t")), F.expr(tx.clean_sql("t"))):
        assert df.where(~fast.eqNullSafe(slow)).count() == 0
    plan = df.select(tx.clean_expr(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert tx.PUNCT_SEARCH in plan and tx.PUNCT_PATTERN not in plan
