"""Language-model scoring with a hashed maximum-entropy model and a class-factored softmax.

Tokens of a text: its words with A-Z lower-cased, then one end token.

Method.  p(token | context) = p(class | context) * p(token | class, context).  The most frequent words and
the end are classes of their own, all other known words are classed by the power of two of their
training count, and tokens never seen in training are one class.  The class softmax is a maximum-entropy
model whose features are hashed: the word before, the two words before, and the word before the last (skip),
``HASHED`` weights rows each, and a bias.  Training tokens are classed by their count without
themselves (leaving one out), so a word seen once teaches what an unseen word looks like.

Words of a class.  A class's words lie in a tree: first ``SUBS`` cells by eighths of the power of two, then, by
their number in the cell, nodes of ``FAN`` children.  At every node on the way to the word a softmax of the same
kind chooses the child: its prior is the children's training tokens (cells) or words (nodes), its features are the
node alone and with each of the class softmax's contexts, hashed to ``WORD_ROWS`` rows each.  So every word's
probability depends on its context, and all known words of a class add up to 1 without a sum over them.
Numbers of words are places in their bucket and cell, with offsets per bucket; the most frequent words, which are
in no tree, leave theirs to the last ones of the cell.

Counting.  Each chunk of documents sends its distinct words once, with their training counts, packed into
one binary row per hash bucket; a bucket adds them up and answers each chunk with the corpus
counts of its words.  So a word of every text arrives once per chunk, and what is gathered grows with
the corpus.  Sums, class sizes and the most frequent words come from small rows per bucket.

Training.  In ``ROUNDS`` rounds, each over its share of the chunks (together: all), every task starts from
the common weights, makes minibatch gradient updates (AdaGrad), and sends its weights in blocks; blocks
are averaged in groups of ``FAN_IN``, so no group grows with the number of tasks: classes' rows by the tasks' tokens,
rows of words' nodes by how often a task met them.  The weights have a fixed size.  Scoring takes chunks of tokens as numpy batches.

Results for special inputs: null and empty texts are the end token alone; a null training mark counts as
training; without training tokens every class but the unseen one is empty (score 0, base log10 of 1 a
token); repeated rows count each; an empty table gives an empty result; an input column with the name
of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (MADE, drop_intermediates, hash_words, mix64, quoted, text_column, tidy, unpack, without,
                     write_chunks, written)
from .ragged import starts

TOP = 40
BANDS = 22
END, UNSEEN = TOP, TOP + 1 + BANDS
CLASSES = UNSEEN + 1
HASHED = 2048
FEATURES = 3
ROUNDS = 2
RATE = 0.1
BATCH = 8192
FEW = 8
SUBS, FAN, FAN_BITS = 8, 16, 4
CELLS = BANDS * SUBS
DEPTH = 13  # of a cell's tree at most: 2^52 words
WORD_BITS = 14
WORD_ROWS = 1 << WORD_BITS
WORD_RATE = 0.5
ODD = 0x9E3779B97F4A7C15
NEVER = -1e4  # log prior of a child without words
BUCKET_BYTES = 64 << 20
FAN_IN = 64
BLOCK_ROWS = 256
WORD_BLOCK_ROWS = 1024
OUTPUTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens(texts):
    """(hash of every token, tokens per text); the end token has hash 0."""
    import numpy as np
    words, lens = [], np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        w = t.encode("utf-8", "surrogatepass").lower().split()
        words.extend(w)
        lens[i] = len(w) + 1
    out = np.zeros(int(lens.sum()), dtype=np.uint64)
    inside = np.ones(len(out), dtype=bool)
    inside[np.cumsum(lens) - 1] = False
    out[inside] = np.maximum(hash_words(words), np.uint64(1))
    return out, lens


def distinct(hashes):
    """(distinct hashes, ascending, index of each hash among them); only the distinct ones are sorted."""
    import numpy as np
    import pandas as pd
    place, keys = pd.factorize(hashes)
    order = np.argsort(keys)
    new = np.empty(len(order), dtype=np.int64)
    new[order] = np.arange(len(order))
    return keys[order], new[place]


def distinct_tokens(hashes, buckets: int):
    """(distinct hashes dealt by bucket, bucket bounds, index of each token among them)."""
    import numpy as np
    keys, place = distinct(hashes)
    bucket = mix64(keys) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    new = np.empty(len(order), dtype=np.int64)
    new[order] = np.arange(len(order))
    return keys[order], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64)), new[place]


def band_of(counts):
    """Class of a count: by its power of two; the unseen class for 0."""
    import numpy as np
    band = np.minimum(np.frexp(np.maximum(counts, 1).astype(np.float64))[1] - 1, BANDS - 1)
    return np.where(counts > 0, TOP + 1 + band, UNSEEN)


def cell_of(counts):
    """Cell of a positive count: its power of two, and which eighth of it."""
    import numpy as np
    band = band_of(counts) - TOP - 1
    return band * SUBS + np.minimum((counts * SUBS >> band) - SUBS, SUBS - 1)


def training_rows(tbl, mark: str):
    import numpy as np
    return np.array([x is None or bool(x) for x in tbl.column(mark).to_pylist()], dtype=bool)


def corpus_counts(chunks: DataFrame, text: str, mark: str, buckets: int) -> DataFrame:
    """Answers (chunk, bucket, counts, ranks) and, with null chunk, one row of sums per bucket.  A rank is a known word's
    place among those of its bucket and cell."""

    def send(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tbl = unpack(blob.as_buffer())
                h, lens = tokens(text_column(tbl, text))
                keys, bounds, place = distinct_tokens(h, buckets)
                count = np.bincount(place[np.repeat(training_rows(tbl, mark), lens)], minlength=len(keys)).astype(np.int64)
                full = np.flatnonzero(bounds[1:] > bounds[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), pa.array(np.full(len(full), chunk), pa.int64()),
                     pa.array([keys[bounds[b]:bounds[b + 1]].tobytes() for b in full], pa.binary()),
                     pa.array([count[bounds[b]:bounds[b + 1]].astype(np.uint32).tobytes() for b in full], pa.binary())],
                    names=["bucket", "chunk", "hashes", "counts"])

    def add(tbl):
        import numpy as np
        import pyarrow as pa
        h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in tbl.column("hashes")])
        c = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in tbl.column("counts")]).astype(np.int64)
        keys, place = distinct(h)
        total = np.zeros(len(keys), dtype=np.int64)
        np.add.at(total, place, c)
        answer, ends = total[place], np.cumsum([len(x.as_buffer()) // 8 for x in tbl.column("hashes")])
        begin = np.concatenate(([0], ends))
        word = keys != 0
        band, without_one = band_of(total) - TOP - 1, band_of(total - 1) - TOP - 1
        known = word & (total > 0)
        held = np.flatnonzero(known)
        cell = cell_of(total[held])
        order, size = np.argsort(cell, kind="stable"), np.bincount(cell, minlength=CELLS)
        ranks = np.zeros(len(keys), dtype=np.uint32)
        ranks[held[order]] = np.arange(len(held)) - starts(size)[cell[order]]
        rank = ranks[place]
        top = np.flatnonzero(word)[np.lexsort((keys[word], -total[word]))[:TOP]]
        sums = {"tokens": int(total.sum()), "types": int((total > 0).sum()), "ends": int(total[~word].sum()),
                "loo": np.bincount(without_one[known], total[known], BANDS + 1).tolist(),
                "words": np.bincount(band[known], minlength=BANDS + 1).tolist(),
                "cells": size.tolist(), "mass": np.bincount(cell, total[held], CELLS).tolist(),
                "top": [{"hash": int(a), "n": int(b), "rank": int(c)}
                        for a, b, c in zip(keys[top].astype(np.int64), total[top], ranks[top], strict=True) if b]}
        n = len(ends)
        return pa.table({
            "chunk": pa.array([*tbl.column("chunk").to_pylist(), None], pa.int64()),
            "bucket": pa.array([*tbl.column("bucket").to_pylist(), tbl.column("bucket")[0].as_py()], pa.int64()),
            "counts": pa.array([*[answer[begin[i]:ends[i]].tobytes() for i in range(n)], None], pa.binary()),
            "ranks": pa.array([*[rank[begin[i]:ends[i]].tobytes() for i in range(n)], None], pa.binary()),
            "sums": pa.array([None] * n + [sums], pa.struct([
                ("tokens", pa.int64()), ("types", pa.int64()), ("ends", pa.int64()),
                ("loo", pa.list_(pa.float64())), ("words", pa.list_(pa.int64())),
                ("cells", pa.list_(pa.int64())), ("mass", pa.list_(pa.float64())),
                ("top", pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64()), ("rank", pa.int64())])))]))})

    sent = chunks.select("chunk", "blob").mapInArrow(tidy(send), "bucket long, chunk long, hashes binary, counts binary")
    return written(sent.groupBy("bucket").applyInArrow(
        add, "chunk long, bucket long, counts binary, ranks binary, sums struct<tokens:bigint,types:bigint,ends:bigint,"
             "loo:array<double>,words:array<bigint>,cells:array<bigint>,mass:array<double>,"
             "top:array<struct<hash:bigint,n:bigint,rank:bigint>>>"), "counts")


class Vocabulary:
    """Sums over all training tokens (a few hundred numbers, and as many per bucket) and the classes and trees
    made from them."""

    def __init__(self, answers: DataFrame, buckets: int):
        import numpy as np
        sums = answers.where("sums IS NOT NULL").select("bucket", "sums.*")
        s = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "ends")]).first()
        self.tokens, self.types, self.ends = s["tokens"], s["types"], s["ends"]

        def by_band(name):
            out = np.zeros(BANDS + 1)
            for r in sums.select(F.posexplode(name).alias("b", "n")).groupBy("b").agg(F.sum("n").alias("n")).collect():
                out[r["b"]] = r["n"]
            return out

        loo, words = by_band("loo"), by_band("words")
        top = (sums.select("bucket", F.explode("top").alias("t")).select("bucket", "t.*").orderBy(F.desc("n"), "hash").limit(TOP).collect())
        counts = np.array([r["n"] for r in top], dtype=np.int64)
        for band, less, n in zip(band_of(counts) - TOP - 1, band_of(counts - 1) - TOP - 1, counts, strict=True):
            loo[less], words[band] = loo[less] - n, words[band] - 1
        h = np.array([r["hash"] for r in top], dtype=np.int64).astype(np.uint64)
        order = np.argsort(h)
        self.top, self.top_class = h[order], order
        mass = np.zeros(CLASSES)  # training tokens by class, each token left out of its own count
        mass[:len(counts)] = counts
        mass[END] = self.ends
        mass[TOP + 1:UNSEEN] = loo[:BANDS] + 0.5 * (words[:BANDS] > 0)
        mass[UNSEEN] = loo[BANDS] + 0.5
        filled = mass.copy()
        filled[TOP + 1:UNSEEN][words[:BANDS] == 0] = 0
        with np.errstate(divide="ignore"):
            self.bias = np.maximum(np.log(filled / filled.sum()), NEVER).astype(np.float32)
        self.number_words(sums.select("bucket", "cells", "mass").collect(), top, buckets)  # CELLS numbers for 64 MB of text

    def number_words(self, rows, top, buckets: int) -> None:
        """First number of each bucket's words in each cell, words per cell, and the priors of the trees' nodes."""
        import numpy as np
        per, mass = np.zeros((buckets, CELLS), dtype=np.int64), np.zeros(CELLS)
        for r in rows:
            per[r["bucket"]] = r["cells"]
            mass += r["mass"]
        self.first, self.size, holes = np.cumsum(per, axis=0) - per, per.sum(axis=0), {}
        for r in top:
            cell = int(cell_of(np.array([r["n"]]))[0])
            holes.setdefault(cell, set()).add(int(self.first[r["bucket"], cell]) + r["rank"])
            mass[cell] -= r["n"]
        self.moved = []  # (cell, number, number it takes): at most TOP
        for cell, gone in holes.items():
            n = int(self.size[cell])
            left = n - len(gone)
            last = [i for i in range(left, n) if i not in gone]
            self.moved += [(cell, i, j) for i, j in zip(last, sorted(j for j in gone if j < left), strict=True)]
            self.size[cell] = left
        self.levels = -(-np.frexp(np.maximum(self.size - 1, 0).astype(np.float64))[1] // FAN_BITS).astype(np.int64)
        self.choice = (self.size.reshape(BANDS, SUBS) > 0).sum(axis=1) > 1  # whether a class has several cells
        count = np.zeros((1 + BANDS + CELLS * DEPTH, FAN))  # children's tokens or words; row 0: a full node
        count[0] = 1
        count[1:1 + BANDS, :SUBS] = np.where(self.size > 0, mass, 0).reshape(BANDS, SUBS)
        for cell in np.flatnonzero(self.levels):  # the last node of each level may lack children
            n = int(self.size[cell])
            for level in range(self.levels[cell]):
                shift = FAN_BITS * int(self.levels[cell] - 1 - level)
                before = [(((n - 1 >> shift + FAN_BITS) << FAN_BITS) + k) << shift for k in range(FAN)]
                count[1 + BANDS + cell * DEPTH + level] = [min(max(n - b, 0), 1 << shift) / (1 << shift) for b in before]
        with np.errstate(divide="ignore"):
            self.prior = np.maximum(np.log(count), NEVER).astype(np.float32)

    def numbers(self, counts, bucket: int, ranks):
        """Numbers in their cells of the words of a bucket."""
        import numpy as np
        return self.first[bucket][cell_of(np.maximum(counts, 1))] + ranks

    def paths(self, kind, counts, numbers):
        """The ways to the words: (nodes on each, place of the first, then per node: its hash, the child, row of ``prior``)."""
        import numpy as np
        shared = np.flatnonzero((kind > END) & (kind < UNSEEN))
        cell, number = cell_of(counts[shared]), numbers[shared].astype(np.int64)
        for c, old, new in self.moved:
            number[(cell == c) & (number == old)] = new
        lens = np.zeros(len(kind), dtype=np.int64)
        choice = self.choice[cell // SUBS].astype(np.int64)
        lens[shared] = n = choice + self.levels[cell]
        word = np.repeat(np.arange(len(shared)), n)
        level = np.arange(len(word)) - np.repeat(starts(n) + choice, n)  # -1: the choice of the cell
        cell, number = cell[word], number[word]
        shift = FAN_BITS * np.maximum(self.levels[cell] - 1 - level, 0)
        above = np.where(level < 0, 0, number >> shift >> FAN_BITS)
        child = np.where(level < 0, cell % SUBS, number >> shift & FAN - 1)
        prior = np.where(level < 0, 1 + cell // SUBS, np.where(
            above == self.size[cell] - 1 >> shift >> FAN_BITS, 1 + BANDS + cell * DEPTH + level, 0))
        key = np.where(level < 0, cell // SUBS, cell * DEPTH + level + BANDS)
        return lens, starts(lens), mix64(above.astype(np.uint64) << np.uint64(12) | key.astype(np.uint64)), child, prior

    def classes(self, keys, counts):
        """Class of each distinct token by its corpus count."""
        import numpy as np
        out = band_of(counts)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, keys), len(self.top) - 1)
            hit = self.top[at] == keys
            out[hit] = self.top_class[at[hit]]
        out[keys == 0] = END if self.ends else UNSEEN
        return out


def contexts(h, lens):
    """Hashes of each token's contexts: the word before, the two words before, the word before the last."""
    import numpy as np
    first = np.cumsum(lens) - lens
    one = np.concatenate((np.zeros(1, np.uint64), h[:-1]))
    two = np.concatenate((np.zeros(2, np.uint64), h[:-2]))[:len(h)]
    one[first] = 1
    two[first] = 2
    second = first[lens > 1] + 1
    two[second] = 2
    return [mix64(one), mix64(two * np.uint64(ODD) + one + np.uint64(7)), mix64(two + np.uint64(11))]


def context_rows(h, lens):
    """Weights rows [tokens, FEATURES] of each token's context; row 0 is the bias."""
    return class_rows(contexts(h, lens))


def class_rows(hashes):
    import numpy as np
    return np.stack([(r % np.uint64(HASHED)).astype(np.int64) + 1 + i * HASHED for i, r in enumerate(hashes)]).T


def word_rows(path, place, hashes, some):
    """(weights rows [nodes, 1 + FEATURES], children, rows of the prior, nodes per token) on the ways to the tokens ``some``."""
    import numpy as np
    lens, first, node, child, prior = path
    n = lens[place[some]]
    at = np.repeat(first[place[some]] - starts(n), n) + np.arange(int(n.sum()))
    token, node = np.repeat(some, n), node[at]
    rows = np.empty((1 + FEATURES, len(at)), dtype=np.int64).T  # a feature's rows side by side
    for f in range(1 + FEATURES):
        x = hashes[f - 1].take(token) if f else np.zeros(len(at), dtype=np.uint64)
        x ^= node
        x *= np.uint64(ODD)
        x >>= np.uint64(64 - WORD_BITS)
        x += np.uint64(f * WORD_ROWS)
        rows[:, f] = x
    return rows, child[at], prior[at], n


def added(w, rows, out):
    """``out`` plus the weights of all features."""
    for f in range(rows.shape[1]):
        out += w.take(rows[:, f], axis=0)
    return out


def logits(w, rows):
    z = w.take(rows[:, 0], axis=0)
    z += w[0]
    return added(w, rows[:, 1:], z)


def exponentials(z):
    """(e to the power of z less its row's highest, in place or in a copy; the highest values; the rows' sums).  Rows of ``FAN``
    values are turned into columns, and their sums add halves of the columns in the order of numpy's sum of a row."""
    import numpy as np
    if z.shape[1] != FAN:
        top = z.max(axis=1)
        z -= top[:, None]
        np.exp(z, out=z)
        return z, top, z.sum(axis=1)
    z = np.ascontiguousarray(z.T)
    top = z.max(axis=0)
    z -= top
    np.exp(z, out=z)
    total = z[:8] + z[8:]
    while len(total) > 1:
        total = total[::2] + total[1::2]
    return z.T, top, total[0]


def softmax(z):
    import numpy as np
    z, _, total = exponentials(z)
    z /= total[:, None]
    return np.ascontiguousarray(z)


def log_share(z, target):
    """Log probability of each row's target; ``z`` is used up."""
    import numpy as np
    own = z[np.arange(len(z)), target].astype(np.float64)
    _, top, total = exponentials(z)
    return own - top - np.log(total)


def put_rows(w, at, x) -> None:
    """``w[at] = x`` for float rows, each copied as one piece of memory."""
    import numpy as np
    row = np.dtype((np.void, w.itemsize * w.shape[1]))
    np.put(w.view(row), at, x.view(row))


def by_row(rows, p):
    """Distinct rows, the sums of p's rows of each, and how many.  Most rows are met a few times: their k-th places are
    added at once, for all such rows; only rows met more than ``FEW`` times are summed one by one."""
    import numpy as np
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # at most 2^16 rows: sorted by radix
    at = rows[order]
    begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.append(begin, len(at)))
    out = np.empty((len(n), p.shape[1]), dtype=p.dtype)
    many = np.flatnonzero(n > FEW)
    if len(many):
        first, size = starts(n[many]), n[many]
        place = np.repeat(begin[many] - first, size) + np.arange(int(size.sum()))
        put_rows(out, many, np.add.reduceat(p.take(order[place], axis=0), first, axis=0))
    few = np.flatnonzero(n <= FEW)
    few = few[np.argsort(-n[few].astype(np.int8), kind="stable")]
    begin_few, left = begin[few], np.bincount(n[few], minlength=FEW + 1)[::-1].cumsum()[::-1]  # left[k]: rows met k times or more
    total = p.take(order[begin_few], axis=0)
    if left[2]:
        rest = p.take(order[begin_few[:left[2]] + 1], axis=0)
        for k in range(3, FEW + 1):
            if left[k]:
                rest[:left[k]] += p.take(order[begin_few[:left[k]] + k - 1], axis=0)
        total[:left[2]] += rest
    put_rows(out, few, total)
    return at[begin], out, n


def descend(w, squares, at, g, rate: float, least) -> None:
    """One AdaGrad update, in place, of the distinct rows ``at`` of the weights by their gradients."""
    import numpy as np
    q = squares.take(at, axis=0)
    q += g * g
    put_rows(squares, at, q)
    q += least
    np.sqrt(q, out=q)
    g *= np.float32(rate)
    g /= q
    new = w.take(at, axis=0)
    new -= g
    put_rows(w, at, new)


def step(w, squares, rows, target) -> None:
    """One minibatch update of the weights, in place."""
    import numpy as np
    p = softmax(logits(w, rows))
    p[np.arange(len(target)), target] -= 1
    p /= np.float32(len(target))
    for f in range(FEATURES):
        at, g, _ = by_row(rows[:, f], p)
        descend(w, squares, at, g, RATE, np.float32(1e-12))


def word_step(w, squares, met, rows, child, prior) -> None:
    """One minibatch update of the weights of words' nodes, in place; ``met`` counts how often each row was used."""
    import numpy as np
    p = softmax(added(w, rows, prior))
    p[np.arange(len(child)), child] -= 1
    for f in range(1 + FEATURES):
        at, g, n = by_row(rows[:, f], p)
        met[at] += n
        descend(w, squares, at, g, WORD_RATE, np.float32(1))


def counted(row, h, buckets, vocabulary):
    """(distinct tokens, their corpus counts and numbers in their cells, index of each token) of one chunk."""
    import numpy as np
    keys, bounds, place = distinct_tokens(h, buckets)
    counts, numbers = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    for a in row:
        own = slice(bounds[a["bucket"]], bounds[a["bucket"] + 1])
        counts[own] = np.frombuffer(a["counts"], np.int64)
        numbers[own] = vocabulary.numbers(counts[own], a["bucket"], np.frombuffer(a["ranks"], np.uint32))
    return keys, counts, numbers, place


def average(blocks: DataFrame, tasks: int) -> DataFrame:
    """Weights (block, n, w) averaged over the tasks by the ``n`` of each row, in groups of at most ``FAN_IN``."""

    def merge(tbl):
        import numpy as np
        import pyarrow as pa
        total = w = 0
        for x, y in zip(tbl.column("n"), tbl.column("w"), strict=True):
            n = np.frombuffer(x.as_buffer(), np.float64)
            total, w = total + n, w + n[:, None] * np.frombuffer(y.as_buffer(), np.float32).reshape(len(n), -1)
        w = (w / np.maximum(total, 1)[:, None]).astype(np.float32)
        return pa.table({"block": tbl.column("block")[:1], "task": tbl.column("task")[:1],
                         "n": pa.array([total.tobytes()], pa.binary()), "w": pa.array([w.tobytes()], pa.binary())})

    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        blocks = (blocks.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("block", "task")
                  .applyInArrow(merge, "block long, task long, n binary, w binary"))
    return blocks


def blocks_of(w, met, size: int, first: int):
    """(number, n, weights) of the blocks of ``size`` rows that training has met."""
    import numpy as np
    return [(first + lo // size, met[lo:lo + size].astype(np.float64).tobytes(), w[lo:lo + size].tobytes())
            for lo in range(0, len(w), size) if met[lo:lo + size].any()]


def train(chunks: DataFrame, text: str, mark: str, vocabulary: Vocabulary, buckets: int):
    """Weights of the classes [1 + FEATURES * HASHED, CLASSES] and of the words' nodes
    [(1 + FEATURES) * WORD_ROWS, FAN] after ``ROUNDS`` rounds."""
    import numpy as np
    w = np.zeros((1 + FEATURES * HASHED, CLASSES), dtype=np.float32)
    w[0] = vocabulary.bias
    words = np.zeros(((1 + FEATURES) * WORD_ROWS, FAN), dtype=np.float32)
    tasks, word_blocks = chunks.rdd.getNumPartitions(), -(-len(w) // BLOCK_ROWS)
    for r in range(ROUNDS):
        common = w, words

        def learn(batches, common=common):
            import pyarrow as pa
            from pyspark import TaskContext
            (w, words), seen = [x.copy() for x in common], 0
            squares, word_squares, met = np.zeros_like(w), np.zeros_like(words), np.zeros(len(words), dtype=np.int64)
            for batch in batches:
                for blob, answers in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    tbl = unpack(blob.as_buffer())
                    h, lens = tokens(text_column(tbl, text))
                    keys, counts, numbers, place = counted(answers, h, buckets, vocabulary)
                    less = vocabulary.classes(keys, counts - 1)
                    path = vocabulary.paths(vocabulary.classes(keys, counts), counts, numbers)
                    own, hashes = np.repeat(training_rows(tbl, mark), lens), contexts(h, lens)
                    rows, target = class_rows(hashes)[own], less[place][own]
                    inner = np.flatnonzero(own & (path[0][place] > 0))
                    for lo in range(0, len(target), BATCH):
                        step(w, squares, rows[lo:lo + BATCH], target[lo:lo + BATCH])
                    for lo in range(0, len(inner), BATCH):
                        at, child, prior, _ = word_rows(path, place, hashes, inner[lo:lo + BATCH])
                        word_step(words, word_squares, met, at, child, vocabulary.prior.take(prior, axis=0))
                    seen += len(target)
            if seen:
                cut = blocks_of(w, np.full(len(w), seen), BLOCK_ROWS, 0) + blocks_of(words, met, WORD_BLOCK_ROWS, word_blocks)
                number, n, part = zip(*cut, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int64()), pa.array([TaskContext.get().partitionId()] * len(cut), pa.int64()),
                     pa.array(n, pa.binary()), pa.array(part, pa.binary())], names=["block", "task", "n", "w"])

        share = chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == r).select("blob", "answers")
        found = average(share.mapInArrow(tidy(learn), "block long, task long, n binary, w binary"), tasks)
        w, words = (x.copy() for x in common)
        for b in found.select("block", "n", "w").collect():  # the model: a fixed number of blocks
            met = np.frombuffer(b["n"], np.float64) > 0
            to, block, size = (w, b["block"], BLOCK_ROWS) if b["block"] < word_blocks else (words, b["block"] - word_blocks, WORD_BLOCK_ROWS)
            part = np.frombuffer(b["w"], np.float32).reshape(len(met), -1)
            to[block * size:block * size + len(met)][met] = part[met]
    return w, words


def score_language_model(docs: DataFrame, text: str = "text", mark: str = "train") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score, learnt from the rows whose
    boolean column ``mark`` is not false."""
    keep, before = without(docs, OUTPUTS), len(MADE)
    docs = docs.select(*[quoted(c) for c in keep])
    chunks = write_chunks(docs, text, "lm")
    buckets = 1 + (chunks.agg(F.sum("raw_bytes")).first()[0] or 0) // BUCKET_BYTES
    answers = corpus_counts(chunks, text, mark, buckets)
    vocabulary = Vocabulary(answers, buckets)
    told = (answers.where("chunk IS NOT NULL").groupBy("chunk")
            .agg(F.collect_list(F.struct("bucket", "counts", "ranks")).alias("answers")))  # the distinct words of a chunk
    both = written(chunks.select("chunk", "blob").join(told, "chunk").select("chunk", "blob", "answers"), "counted")
    drop_intermediates(docs.sparkSession, before, ("counted",))
    weights, words = train(both, text, mark, vocabulary, buckets)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                           T.StructField("score", T.DoubleType())])

    def score(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for blob, answers in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                tbl = unpack(blob.as_buffer())
                h, lens = tokens(text_column(tbl, text))
                keys, counts, numbers, place = counted(answers, h, buckets, vocabulary)
                kind, hashes = vocabulary.classes(keys, counts), contexts(h, lens)
                total, rows, target = np.zeros(len(h)), class_rows(hashes), kind[place]
                for lo in range(0, len(h), BATCH):
                    total[lo:lo + BATCH] = log_share(logits(weights, rows[lo:lo + BATCH]), target[lo:lo + BATCH])
                path = vocabulary.paths(kind, counts, numbers)
                inner = np.flatnonzero(path[0][place] > 0)
                for lo in range(0, len(inner), BATCH):
                    at, child, prior, n = word_rows(path, place, hashes, inner[lo:lo + BATCH])
                    taken = log_share(added(words, at, vocabulary.prior.take(prior, axis=0)), child)
                    total[inner[lo:lo + BATCH]] += np.add.reduceat(taken, starts(n))
                base = np.log10((counts + 0.5) / (vocabulary.tokens + 0.5 * (vocabulary.types + 1)))[place]
                first = np.cumsum(lens) - lens
                for name, x in (("n_tokens", pa.array(lens, pa.int64())),
                                ("n_known", pa.array(np.add.reduceat((counts > 0).astype(np.int64)[place], first), pa.int64())),
                                ("train_tokens", pa.array([vocabulary.tokens] * len(lens), pa.int64())),
                                ("base_score", pa.array(np.add.reduceat(base, first), pa.float64())),
                                ("score", pa.array(np.add.reduceat(total, first) / np.log(10), pa.float64()))):
                    tbl = tbl.append_column(name, x)
                yield from tbl.to_batches(max_chunksize=2000)

    return both.select("blob", "answers").mapInArrow(tidy(score), schema)
