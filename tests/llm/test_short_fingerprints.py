"""Fingerprints of texts of every small length, and of long texts."""

import random

from textprice.llm import syncmers

from .test_text_operators import frame


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def near(a, b):
    return syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(b))


def test_only_the_empty_text_has_no_anchor():
    rng = random.Random(2)
    for n in range(1, 61):
        for _ in range(20):
            a, b = ("".join(rng.choice(LETTERS) for _ in range(n)) for _ in range(2))
            assert len(syncmers.closed_syncmers(a)[0]) > 1
            assert near(a, a) == 1.0 and near(a, "") == 0.0
            if n >= 4:
                assert near(a, b) < 0.5
    assert near("", "") == 1.0


def test_short_texts_that_share_a_half_are_alike(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice(LETTERS + " ") for _ in range(n)) for n in range(2, 121)]
    rows = syncmers.fingerprint_with_next(frame(spark, texts)).collect()
    assert all(0 < r["near_edited"] < 1 for r in rows if r["edited_text"] != r["text"])
    assert all(r["near_next"] < 0.2 for r in rows if len(r["text"]) > 8)
    for r in rows:  # from the returned fingerprints alone
        a, b = ({f[i:i + 8] for i in range(0, len(f), 8)} for f in (r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_edited"] == len(a & b) / len(a | b)


def test_texts_that_begin_with_a_text_are_less_alike_the_longer_they_are():
    """No length is special: likeness falls step by step, and is never 0."""
    rng = random.Random(3)
    for n in (3, 10, 32, 95, 96, 300):
        runs = []
        for _ in range(30):
            whole = "".join(rng.choice(LETTERS + " ") for _ in range(2000))
            runs.append([near(whole[:n], whole[:m]) for m in range(n, n + 400, 4)])
        mean = [sum(r[i] for r in runs) / len(runs) for i in range(100)]
        assert mean[0] == 1.0 and all(x > 0 for r in runs for x in r)
        assert all(mean[i + 1] < mean[i] + 0.01 for i in range(99))  # falls
        assert all(mean[i] - mean[i + 1] < 0.06 + 0.5 * 4 / n for i in range(1, 99))  # without a drop
        assert mean[99] < 0.2 + 1.5 * n / (n + 396)
    for n in range(5, 400, 13):
        a = "".join(rng.choice(LETTERS + " ") for _ in range(n))
        assert near(a, a[:-1]) > (0.25 if n > 30 else 0)


def test_passages_that_moved_by_shifts_of_their_own_are_aligned():
    rng = random.Random(6)
    parts = ["".join(rng.choice(LETTERS + " ") for _ in range(500)) for _ in range(4)]
    a, b = syncmers.placed("".join(parts)), syncmers.placed(parts[0] + "word " + parts[1] + parts[2] + "two words " + parts[3])
    assert syncmers.aligned(a, b) > 0.85 * syncmers.likeness(a[0], b[0]) > 0.7
    c = syncmers.placed(parts[2] + parts[0] + parts[3] + parts[1])
    assert syncmers.aligned(a, c) > 0.85 * syncmers.likeness(a[0], c[0]) > 0.6


def test_fingerprints_grow_with_the_text_and_keep_positions(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, tail = text(300), text(5000)
    x, y = text(40_000) + passage + text(20_000), text(10_000) + passage + text(50_000)  # half a percent in common
    rows = {r["doc_id"]: r for r in syncmers.fingerprint_with_next(frame(spark, [x, y, "moved " + tail, tail])).collect()}
    for i, t in enumerate((x, y)):
        at, hashes = syncmers.closed_syncmers(t)
        want = {int(h) >> 32: int(p) + syncmers.K - 1 for p, h in zip(at[::-1], hashes[::-1], strict=True)}
        assert len(want) > 5000 and len(rows[i]["fingerprint"]) == 8 * len(want)
        got = [[int(v[c:c + 8], 16) for c in range(0, len(v), 8)] for v in (rows[i]["fingerprint"], rows[i]["positions"])]
        assert dict(zip(*got, strict=True)) == want and got[0] == sorted(want)
    a, b = (set(syncmers.fingerprint(t).tolist()) for t in (x, y))
    assert rows[0]["near_next"] == len(a & b) / len(a | b) > 0.001
    assert rows[0]["aligned_next"] > 0.8 * rows[0]["near_next"]
    assert rows[2]["near_next"] > 0.96 and rows[2]["aligned_next"] > 0.96  # one shift of six code points, and the first ones
    assert 0.3 < rows[0]["near_edited"] < 0.37 and abs(rows[0]["aligned_edited"] - rows[0]["near_edited"]) < 0.01
    words = [text(9) for _ in range(400)]
    p, q = ("".join(w) for w in (words, rng.sample(words, len(words))))  # pieces of one anchor or two, all at shifts of their own
    assert syncmers.aligned(syncmers.placed(p, 8, 3), syncmers.placed(q, 8, 3)) < 0.5 * syncmers.likeness(
        syncmers.fingerprint(p, 8, 3), syncmers.fingerprint(q, 8, 3))
