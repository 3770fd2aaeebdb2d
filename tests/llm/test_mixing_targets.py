"""Targets of monolingual sources: consistent ones are met, contradictory ones are warned of."""

import warnings

import pytest

from textprice.llm import mixing
from textprice.llm.queries import QUERIES


def test_monolingual_sources(spark, tmp_path):
    kinds = ("w", "w | x", "w copyright")
    rows = [(f"{kinds[(i + n) % 3]} " + "w " * (i % 17), lang, source)
            for n, (source, lang) in enumerate((("a", "en"), ("b", "en"), ("c", "de"), ("d", "fr"))) for i in range(20 * (n + 1) ** 2)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        out = [r.asDict() for r in QUERIES["op5_mix_sources"](spark, str(tmp_path)).collect()]
    cells = {}
    for r in out:
        key = (r["source"], r["lang"], r["topic"])
        cells[key] = cells.get(key, 0) + r["n_tokens"]
    lifted = {k: v ** mixing.TEMPER for k, v in cells.items()}
    for i in range(3):
        for value in {k[i] for k in cells}:
            want = sum(v for k, v in lifted.items() if k[i] == value) / sum(lifted.values())
            assert abs(sum(r["weight"] for r in out if (r["source"], r["lang"], r["topic"])[i] == value) - want) < 1e-6


def test_contradictory_targets_are_told(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_ROUNDS", 5)
    docs = spark.createDataFrame([(0, "w w", "en", "a"), (1, "w w", "de", "b")], "doc_id long, text string, lang string, source string")
    with pytest.warns(RuntimeWarning, match="missed by up to 0.4"):
        mixing.mix_sources(docs, source_shares={"a": 0.5, "b": 0.5}, language_shares={"en": 0.9, "de": 0.1})


def chances(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    out = [r.asDict() for r in mixing.mix_sources(df, joint=True).collect()]
    return out, {(r["source"], r["lang"], r["topic"]): r["probability"] for r in out if r["n_tokens"]}


def test_a_tiny_source_changes_nothing_else(spark):
    """A source of 100 tokens in a language of its own: taken whole; what is kept of all others stays as it was."""
    rows = [("w " * (20 + i % 40) + ("w | x" if i % 5 == 0 else ""), ("en", "de", "fr")[i % 3], ("a", "a", "b", "c")[i % 4]) for i in range(3000)]
    out, before = chances(spark, rows)
    share = sum(r["probability"] * r["n_tokens"] for r in out) / sum(r["n_tokens"] for r in out)
    assert abs(share - mixing.KEEP) < 1e-3
    more, after = chances(spark, [*rows, ("w " * 100, "xx", "tiny")])
    assert after["tiny", "xx", "prose"] == 1.0
    assert all(abs(after[k] - before[k]) < 5e-3 for k in before)
    share = sum(r["probability"] * r["n_tokens"] for r in more) / sum(r["n_tokens"] for r in more)
    assert abs(share - mixing.KEEP) < 1e-3


def test_share_kept_does_not_depend_on_size(spark):
    rows = [("w " * (5 + i % 7), ("en", "de")[i % 2], ("a", "b")[i % 3 == 0]) for i in range(200)] + [("w w", "fr", "c")]
    _, once = chances(spark, rows)
    _, often = chances(spark, rows * 6)
    assert all(abs(once[k] - often[k]) < 1e-3 for k in once)


def test_every_language_has_its_own_marginal_and_long_texts_count(spark):
    rows = [("w " * 60000, "en", "a"), ("w " * 50, "ja", "a"), ("w " * 40, "sw", "a"), ("w " * 30, None, "a"), (None, "zu", None)]
    out, _ = chances(spark, rows)
    lifted = {n: n ** mixing.TEMPER for n in (60000, 50, 40, 30)}
    for r in out:
        assert abs(r["weight"] - (lifted.get(r["n_tokens"], 0) / sum(lifted.values()))) < 1e-6
    assert [r["probability"] for r in sorted(out, key=lambda r: -r["n_tokens"])][1:4] == [1.0, 1.0, 1.0]
