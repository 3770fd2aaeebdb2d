"""Sums of gradients by row."""

from textprice.llm import maxent_lm


def test_few_long_groups_are_summed_one_by_one(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = np.concatenate((np.arange(500), np.repeat(np.arange(40), np.arange(40)), np.full(700, 77)))
    rows = rng.permutation(rows)
    p = rng.integers(-9, 9, (len(rows), 16)).astype(np.float32)  # whole numbers: sums are exact in any order
    summed = []
    whole = np.add

    class Add:
        def __getattr__(self, name):
            return getattr(whole, name)

        def reduceat(self, x, places, axis):
            summed.append(len(places))
            return whole.reduceat(x, places, axis=axis)

    monkeypatch.setattr(np, "add", Add())
    at, sums, n = maxent_lm.by_row(rows, p)
    monkeypatch.undo()
    naive = np.zeros((500, 16))
    np.add.at(naive, rows, p)
    assert (at == np.arange(500)).all() and (sums == naive).all() and (n == np.bincount(rows)).all()
    assert sum(summed) == (n > maxent_lm.FEW).sum() < 50  # before: all 500


def test_sums_of_one_row_and_of_rows_met_once():
    import numpy as np
    for rows in (np.zeros(3, np.int64), np.arange(4), np.array([2])):
        p = np.ones((len(rows), 2), dtype=np.float32)
        at, sums, n = maxent_lm.by_row(rows, p)
        assert at.tolist() == sorted(set(rows.tolist())) and (sums[:, 0] == n).all() and n.sum() == len(rows)
