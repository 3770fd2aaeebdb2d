"""op7's softmaxes, updates and distinct tokens: the same numbers with less work per row."""

import numpy as np

from textprice.llm import maxent_lm


class Rows(np.ndarray):
    """Notes along which axis it is summed."""
    summed: list = []

    def sum(self, axis=None, **named):
        Rows.summed.append(axis)
        return super().sum(axis=axis, **named)


def test_short_rows_are_not_summed_row_by_row():
    rng = np.random.default_rng(1)
    for width in (maxent_lm.FAN, maxent_lm.CLASSES):
        z = (9 * rng.normal(size=(3001, width))).astype(np.float32)
        z[:5, 3:] = maxent_lm.NEVER
        z[7] = 0
        e = np.exp(z - z.max(axis=1)[:, None])
        Rows.summed = []
        p = maxent_lm.softmax(z.copy().view(Rows))
        if width == maxent_lm.FAN:
            assert Rows.summed == []  # before: [1]
        assert np.array_equal(p, e / e.sum(axis=1, keepdims=True)) and p.flags.c_contiguous  # to the last bit
        target = rng.integers(0, width, len(z))
        own = z[np.arange(len(z)), target].astype(np.float64)
        assert np.array_equal(maxent_lm.log_share(z.copy(), target), own - z.max(axis=1) - np.log(e.sum(axis=1)))
        assert maxent_lm.softmax(z[:0].copy()).shape == (0, width) and len(maxent_lm.log_share(z[:0].copy(), target[:0])) == 0


def test_only_distinct_hashes_are_sorted(monkeypatch):
    rng = np.random.default_rng(2)
    some = np.concatenate((rng.integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2), np.array([0, 1, (1 << 64) - 1], np.uint64)))
    hashes = rng.permutation(np.concatenate((some, rng.choice(some, 5000))))
    expected = np.unique(hashes, return_inverse=True)
    sorted_whole = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda x, **named: sorted_whole.append(len(x)) or unique(x, **named))
    keys, bounds, place = maxent_lm.distinct_tokens(hashes, 3)
    monkeypatch.undo()
    assert sorted_whole == []  # before: all 5053 tokens
    assert np.array_equal(keys[place], hashes) and np.array_equal(np.sort(keys), expected[0])
    assert bounds.tolist()[0] == 0 and bounds.tolist()[-1] == len(keys)
    for b in range(3):
        own = keys[bounds[b]:bounds[b + 1]]
        assert (maxent_lm.mix64(own) % np.uint64(3) == b).all() and (own[1:] > own[:-1]).all()
    for x in (hashes, hashes[:1], hashes[:0]):
        for got, want in zip(maxent_lm.distinct(x), np.unique(x, return_inverse=True), strict=True):
            assert np.array_equal(got, want)


def test_updates_are_those_of_plain_assignments():
    rng = np.random.default_rng(3)
    for width in (maxent_lm.FAN, maxent_lm.CLASSES):
        w, squares = (rng.random(size=(300, width)).astype(np.float32) for _ in range(2))
        for at in (np.array([], dtype=np.int64), np.array([0]), np.array([299, 4, 17]), np.arange(300)):
            g = rng.normal(size=(len(at), width)).astype(np.float32)
            new_w, new_squares = w.copy(), squares.copy()
            new_squares[at] += g * g
            new_w[at] -= g * np.float32(0.5) / np.sqrt(new_squares[at] + np.float32(1))
            maxent_lm.descend(w, squares, at, g, 0.5, np.float32(1))
            assert np.array_equal(w, new_w) and np.array_equal(squares, new_squares)


def test_rows_of_words_take_all_numbers_of_16_bits():
    last = (1 + maxent_lm.FEATURES) * maxent_lm.WORD_ROWS - 1
    rows = np.array([[last, 0], [last, 1], [last - 1, 0]])
    at, sums, n = maxent_lm.by_row(rows[:, 0], np.ones((3, 2), dtype=np.float32))
    assert last < 1 << 16 and at.tolist() == [last - 1, last] and sums[:, 0].tolist() == [1, 2] and n.tolist() == [1, 2]
