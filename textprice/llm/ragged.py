"""Texts of an Arrow batch as flat arrays: slices of bounded size, tokens cut out of one byte buffer,
distinct tokens and their numbers, and rows of unequal length gathered at once."""

from __future__ import annotations

SLICE_BYTES = 4 << 20


def slices(sizes, limit: int = SLICE_BYTES):
    """(from, to) of neighbouring rows whose sizes add up to ``limit`` at most; a larger row is alone."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def starts(lens):
    """Where each row starts when rows of these lengths follow one another."""
    import numpy as np
    return np.cumsum(lens) - lens


def gather(flat, first, lens, rows):
    """The rows ``rows`` of a flat array of rows (``lens`` values from ``first`` on), one after another."""
    import numpy as np
    n = lens[rows]
    at = np.repeat(first[rows] - starts(n), n)
    at += np.arange(len(at))
    return flat[at]


def distinct(data, bounds):
    """(numbers, tokens): the byte strings between neighbouring ``bounds`` of ``data`` by number, and each
    of them once, in order of first place."""
    import numpy as np
    import pyarrow as pa
    tokens = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                   [None, pa.py_buffer(np.ascontiguousarray(bounds, dtype=np.int64)), pa.py_buffer(data)])
    coded = tokens.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
