"""Substring and near de-duplication, syncmers and licence scans against brute force, and the
defined results for null, empty, long, repeated and clashing inputs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from textprice.llm import licenses, near_dedup, syncmers
from textprice.llm.common import mix64
from textprice.llm.substring_dedup import substring_dedup, window_hashes

SCHEMA = "doc_id long, text string, chunk string, bucket int, n_words string, class_id string"


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=1):
    rng = random.Random(seed)
    passage = prose(rng, 12)
    texts = []
    for i in range(40):
        words = prose(rng, rng.randrange(3, 60))
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage
        texts.append("  ".join(words[:20]) + "\n\t" + " ".join(words[20:]))
    base = prose(rng, 80)
    for i in range(12):  # near copies, each with one word changed
        copy = list(base)
        copy[rng.randrange(80)] = f"n{i}"
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0], "", None, None, "   ", "a", "a b", "a b", " ".join(prose(rng, 3000)), "same " * 50, "é x   y"]
    return texts


def words_of(text):
    return (text or "").encode().split()


def test_window_hashes_match_direct_sums():
    w = mix64(np.arange(50, dtype=np.uint64))
    base = 0x9E3779B97F4A7C15
    direct = [sum(int(w[i + j]) * pow(base, j, 1 << 64) for j in range(7)) % (1 << 64) for i in range(44)]
    assert window_hashes(w, 7, base).tolist() == direct
    assert len(window_hashes(w[:3], 7, base)) == 0


@pytest.mark.parametrize("bucket_windows", [1 << 21, 50])
def test_substring_dedup_brute_force(spark, bucket_windows):
    texts, width = corpus(), 6
    seen = Counter(tuple(ws[i:i + width]) for ws in map(words_of, texts) for i in range(len(ws) - width + 1))
    want = {}
    for i, t in enumerate(texts):
        ws = words_of(t)
        gone = {i + j for i in range(len(ws) - width + 1) if seen[tuple(ws[i:i + width])] > 1 for j in range(width)}
        want[i] = (len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode())
    out = substring_dedup(frame(spark, texts), width=width, bucket_windows=bucket_windows)
    assert out.columns == ["doc_id", "text", "chunk", "bucket", "class_id", "n_words", "n_removed", "removed_spans", "kept_text"]
    rows = out.collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in rows} == want
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["removed_spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed_spans"], r["removed_spans"][1:], strict=False))


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert substring_dedup(empty).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0
    assert syncmers.fingerprint_with_next(empty).count() == 0
    assert syncmers.anchors(empty).count() == 0
    assert licenses.scan_licenses(empty).count() == 0


def shingle_set(text):
    ws = words_of(text)
    return frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def brute_classes(texts, threshold=0.8):
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= threshold:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("cell", [2, 512])
def test_near_duplicates_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dedup, "CELL", cell)
    monkeypatch.setattr(near_dedup, "HUBS", max(1, cell // 8))
    texts = corpus(2)
    want = brute_classes(texts)
    out = near_dedup.near_duplicates(frame(spark, texts))
    assert out.columns == ["doc_id", "text", "chunk", "bucket", "n_words", "class_id", "kept"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [rows[i]["class_id"] for i in range(len(texts))] == want
    kept = Counter(r["class_id"] for r in rows.values() if r["kept"])
    assert kept == Counter(set(want)) and all(rows[c]["kept"] for c in kept)


def test_near_duplicates_of_null_and_repeated_keys(spark):
    out = near_dedup.near_duplicates(frame(spark, ["a b c d e f"] * 3 + ["x", None], [None, 7, 7, None, 5])).collect()
    got = sorted((r["text"] or "", r["doc_id"] is None, r["class_id"], r["kept"]) for r in out if r["text"] != "x")
    assert [g[2] for g in got] == [5, 7, 7, 7] and sum(g[3] for g in got) == 2
    assert [(r["class_id"], r["kept"]) for r in out if r["text"] == "x"] == [(None, True)]


def test_near_duplicates_by_shingle_numbers(spark):
    line = " ".join(f"l{i}" for i in range(12))
    texts = ["\n".join([line] * 20 + [f"tail {t} of its own here"]) for t in "abc"] + [line]
    by = {w: [r["class_id"] for r in sorted(near_dedup.near_duplicates(frame(spark, texts), weights=w, rows=False).collect())]
          for w in ("set", "count")}
    assert by == {"set": [0, 1, 2, 3], "count": [0, 0, 0, 3]}


@pytest.mark.parametrize("cell", [1, 5, 512])
def test_buckets_of_dissimilar_members_are_checked_whole(spark, monkeypatch, cell):
    """Texts that share one long passage meet in buckets without being similar; copies hide among them."""
    monkeypatch.setattr(near_dedup, "CELL", cell)
    monkeypatch.setattr(near_dedup, "HUBS", max(1, cell // 8))
    rng = random.Random(5)
    passage = prose(rng, 60)
    texts = [" ".join(passage + prose(rng, 45, 10_000)) for _ in range(25)]
    texts += [t.rsplit(" ", 2)[0] + " end" for t in texts[10:14]]
    out = near_dedup.near_duplicates(frame(spark, texts), rows=False).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == dict(enumerate(brute_classes(texts)))


def test_close_pairs_are_those_the_filters_let_through():
    rng = np.random.default_rng(8)
    for trial in range(40):
        rows = rng.integers(1, 120)
        group = np.sort(rng.integers(0, rng.integers(1, 12), rows))
        n = rng.integers(5, 60, rows)
        order = np.lexsort((n, group))
        group, n = group[order], n[order]
        label, own, left = rng.integers(0, 6, rows), rng.integers(0, 1 + trial % 2, rows), (n * rng.random(rows)).astype(int)
        got = set(zip(*(x.tolist() for x in near_dedup.close_pairs(group, label, n, left, own, 0.8)), strict=True))
        want = set()
        for i in range(rows):
            for j in range(i + 1, rows):
                if group[i] != group[j] or label[i] == label[j] or n[i] < 0.8 * n[j] - 1e-9:
                    continue
                if len(set(own[group == group[i]])) > 1 and own[i] == own[j]:
                    continue
                if 1 + min(left[i], left[j]) >= 0.8 / 1.8 * (n[i] + n[j]) - 1e-6:
                    want.add((i, j))
        assert got == want


def test_every_two_rows_of_a_bucket_meet_in_one_cell(spark):
    pool = spark.range(60).selectExpr("CASE WHEN id < 40 THEN 1 ELSE id END AS bucket", "id AS rid")
    rows = near_dedup.cells(pool, 7, False).collect()
    met = Counter()
    for key in {(r.bucket, r.cell) for r in rows}:
        inside = [r for r in rows if (r.bucket, r.cell) == key]
        alone = len({r.own for r in inside}) == 1
        met.update(frozenset((a.rid, b.rid)) for a in inside for b in inside if a.rid < b.rid and (alone or a.own != b.own))
    pairs = {frozenset((a, b)) for a in range(40) for b in range(a)}
    assert set(met) == pairs and max(len([r for r in rows if r.rid == i]) for i in range(40)) == 6
    star = near_dedup.cells(pool, 7, True).collect()
    first = {r.rid for r in star if r.bucket == 1 and r.own == 0}
    assert first and all({(r.rid, r.cell) for r in star if r.rid == i and r.bucket == 1} for i in range(40))
    assert sum(r.bucket == 1 for r in star) == 40 - len(first) + 6 * len(first)


def test_dart_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    ids = mix64(np.arange(3000, dtype=np.uint64))
    for overlap, weights in ((900, None), (300, None), (700, "count")):
        agree, n = [], 1000
        for t in range(12):
            shift = mix64(ids + np.uint64(t))
            wa = np.ones(n) if weights is None else rng.integers(1, 5, n).astype(float)
            wb = np.ones(n) if weights is None else np.concatenate((wa[n - overlap:], rng.integers(1, 5, n - overlap))) - 0.5
            a, b = shift[:n], shift[n - overlap:2 * n - overlap]
            sa, sb = near_dedup.dart_signatures(np.concatenate((a, b)), np.concatenate((wa, wb)), np.array([n, n]), 130)
            agree.append((sa == sb).mean())
            here, there = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
            less = sum(min(here[x], there[x]) for x in here.keys() & there.keys())
            true = less / (wa.sum() + wb.sum() - less)
            alone = near_dedup.dart_signatures(a[::-1].copy(), wa[::-1].copy(), np.array([n]), 130)
            assert (alone[0] == sa).all()  # neither order nor neighbours matter
        assert abs(np.mean(agree) - true) < 0.04
    sizes = np.array([1, 3, 700, 2])
    many = near_dedup.dart_signatures(ids[:706], np.ones(706), sizes, 130)
    ends = np.cumsum(sizes)
    for row, e, n in zip(many, ends, sizes, strict=True):
        assert (near_dedup.dart_signatures(ids[e - n:e], np.ones(n), np.array([n]), 130)[0] == row).all()


def naive_syncmers(text, k, s):
    def h(x):
        if set(x) == {syncmers.MARK} and len(x) == s:
            return 0
        v = 0
        for c in x:
            v = (v * syncmers.BASE + c) % (1 << 64)
        return int(mix64(np.array([v], dtype=np.uint64))[0])

    out, codes = [], [syncmers.MARK] * (k - 1) + [ord(c) for c in text] + [syncmers.MARK] * (k - 1)
    for i in range(len(codes) - k + 1) if text else ():
        inner = [h(codes[i + j:i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i - (k - 1), h(codes[i:i + k])))
    return out


def test_closed_syncmers_brute_force_and_context_free():
    rng = random.Random(8)
    text = "".join(rng.choice("abcdeé \U0001F600") for _ in range(400))
    for k, s in ((16, 5), (24, 8), (9, 4), (5, 5)):
        at, h = syncmers.closed_syncmers(text, k, s)
        assert list(zip(at.tolist(), h.tolist(), strict=True)) == naive_syncmers(text, k, s)
    inside = {(p - 50, x) for p, x in naive_syncmers(text, 24, 8) if 50 <= p <= 276}
    assert inside == {(p, x) for p, x in naive_syncmers(text[50:300], 24, 8) if 0 <= p <= 226}
    assert naive_syncmers("abc", 24, 8) == [(int(p), int(x)) for p, x in zip(*syncmers.closed_syncmers("abc", 24, 8), strict=True)]


def test_fingerprints_with_next_document(spark):
    texts = corpus(4)
    ids = [i * 3 - 20 for i in range(len(texts))]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    docs = frame(spark, [texts[i] for i in order], [ids[i] for i in order])
    rows = {r["doc_id"]: r for r in syncmers.fingerprint_with_next(docs).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, nxt, r = t or "", texts[(i + 1) % len(texts)] or "", rows[ids[i]]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert (r["n_chars"], r["edited_text"]) == (len(t), edited)
        f, e, n = (syncmers.fingerprint(x) for x in (t, edited, nxt))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (syncmers.hex_of(f), syncmers.hex_of(e))
        a, b = set(f.tolist()), set(n.tolist())
        union = sorted(a | b)[:syncmers.SIZE] if syncmers.SIZE in (len(a), len(b)) else sorted(a | b)
        assert r["near_next"] == (len(a & b & set(union)) / len(union) if union else 1.0)
        assert 0 <= r["near_edited"] <= 1


def test_fingerprints_of_ties_nulls_and_single_rows(spark):
    rows = syncmers.fingerprint_with_next(frame(spark, ["bbb", "aaa", None, "ccc"], [4, 4, None, 4])).collect()
    assert sorted((r["doc_id"] is not None, r["edited_text"]) for r in rows) == [(False, ""), (True, "aab"), (True, "bbc"), (True, "cc")]
    one = syncmers.fingerprint_with_next(frame(spark, ["abcd"])).first()
    assert (one["edited_text"], one["near_next"], one["aligned_next"]) == ("abab", 1.0, 1.0)


def test_anchors_of_texts(spark):
    rows = {r["doc_id"]: r["anchors"] for r in syncmers.anchors(frame(spark, ["x" * 10, None, "hello " * 20])).collect()}
    assert len(rows[0]) > 1 and rows[1] == [] and [a["position"] for a in rows[2]] == syncmers.closed_syncmers("hello " * 20)[0].tolist()


def test_licenses_brute_force_without_size_bounds(spark):
    rng = random.Random(6)
    texts = corpus(9)
    for name, body in licenses.TEMPLATES:
        words = body.split()
        texts += [body, f"x y z\n{body.upper()}\nmore", " ".join(words[:-1]), f"{name}\n" + " ".join(words + prose(rng, 2)), body + " " + body]
    templates = [(n, licenses.bigrams_of(licenses.words_of(b))) for n, b in licenses.TEMPLATES]

    def best(text):
        own = licenses.bigrams_of(licenses.words_of(text))
        scored = [(2 * len(own & b) / (len(own) + len(b)), -i, n) for i, (n, b) in enumerate(templates) if own]
        return max((s for s in scored if s[0] >= 0.8), default=None)

    rows = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        lines = [best(x) for x in (t or "").split("\n")]
        top = max((b for b in [*lines, best(t or "")] if b), default=None)
        assert (rows[i]["license"], rows[i]["license_score"], rows[i]["n_license_lines"]) == \
            ((top[2], top[0]) if top else (None, None)) + (sum(b is not None for b in lines),), t


def test_equal_texts_have_equal_hashes_across_processes(spark):
    out = substring_dedup(frame(spark, ["a b c"] * 2 + ["d"]), width=3).collect()
    kept = defaultdict(set)
    for r in out:
        kept[r["text"]].add(hashlib.sha256(r["kept_text"].encode()).hexdigest())
    assert {k: len(v) for k, v in kept.items()} == {"a b c": 1, "d": 1}
    assert {r["text"]: r["n_removed"] for r in out} == {"a b c": 3, "d": 0}
