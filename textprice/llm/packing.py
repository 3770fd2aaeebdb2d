"""Best-fit packing of tokenised documents into sequences of at most ``capacity`` tokens.

Method (minimum bin slack).  Pieces of one length are interchangeable, so the whole corpus is
described by its length histogram: ``capacity`` counts at most, however large the corpus.  Per
bin, the longest piece left is placed and a subset-sum over the lengths still available (a bitset,
one bit per fill) finds the fullest feasible combination for the rest.  The combination is taken
out as many times as the counts allow, as one *pattern*; each pattern uses some length up, so there
are a few thousand patterns at most.  The histogram and the patterns are the only things that pass
through the driver.  Every piece then finds its place by its number among the pieces of its
length: a number counted by the task that made the piece, plus an offset from a small table of
(task, length) counts.

Tokenising happens once: pieces are written to the shared folder.  A byte-pair vocabulary that
never joins characters across white space (each worker probes it) gives a text the ids of its words, so
distinct words are encoded on their own, kept in a bounded cache per worker, and texts put together from
their ids.  Other vocabularies get whole texts.

Results for special inputs: a null text is the empty text; every document ends with ``end_id``, so
even an empty one is a piece of one token; a very long one is cut into pieces of ``capacity``
tokens and a rest; repeated rows are packed each on their own; an empty table gives an empty result.
An input column with the name of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, tidy, without, worker_state, written
from .ragged import SLICE_BYTES, distinct, gather, slices, starts

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 600_000
OUTPUTS = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "_task", "_nth")


def load_tokenizer(file: str):
    """A tokenizers file: a path, or the name of a public vocabulary file."""
    import os

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if os.sep not in file:
        import public_tokenizers
        file = public_tokenizers.path(file)
    return Tokenizer.from_file(file)


# White space that ends a word, and the kinds of neighbours that a vocabulary might join across it.
WHITE, PROBES = b" \t\n\x0b\x0c\r", ("a", "A", "é", "7", ".", "-", "'", "'s", "北", "<", "ab7.")


def encodes_by_word(tokenizer) -> bool:
    """Whether white space only separates: text of every kind on both sides of it has the ids of its parts."""

    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    alone = {p: ids(p) for p in PROBES}
    for space in [chr(c) for c in WHITE] + ["  ", "\r\n"]:
        if ids(space) or any(ids(space + p) != alone[p] or ids(p + space) != alone[p] for p in PROBES):
            return False
        if any(ids(p + space + q) != alone[p] + alone[q] for p in PROBES for q in PROBES):
            return False
    return True


class WordEncoder:
    """Ids of texts.  The words of a slice are made distinct in Arrow, encoded once and put together by one
    gather.  Of the words' ids it keeps two generations of ``cached_words`` each: when the young one is full
    it becomes the old one, and words met again come back from there, so frequent words stay.  A vocabulary
    that does more with white space than to separate words gets whole texts."""

    def __init__(self, tokenizer, cached_words: int = CACHED_WORDS):
        self.tokenizer, self.cached_words, self.young, self.old = tokenizer, cached_words, {}, {}
        self.by_word = encodes_by_word(tokenizer)

    def listed(self, texts) -> list[bytes]:
        import numpy as np
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of distinct words."""
        young, old = self.young, self.old
        found = [young.get(w) or old.get(w) for w in words]  # one without ids is encoded each time
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            for i, ids in zip(new, self.listed([words[i].decode("utf-8") for i in new]), strict=True):
                found[i] = ids
        young.update(zip(words, found, strict=True))
        if len(young) > self.cached_words:
            self.young, self.old = {}, young
        return found

    def encode(self, texts: list[str]):
        """(ids of all texts one after another, number of ids of each)."""
        import numpy as np
        coded = [t.encode("utf-8", "replace") for t in texts]
        if not self.by_word:
            ids = self.listed([t.decode("utf-8") for t in coded])
            return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) >> 2 for x in ids], dtype=np.int64)
        data = b" ".join(coded)
        white = np.zeros(256, dtype=bool)
        white[list(WHITE)] = True
        edge = np.diff((~white[np.frombuffer(data, dtype=np.uint8)]).astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(begin):
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        rows, words = distinct(data, np.stack((begin, end), axis=1).ravel())  # words alternate with white space
        rows = rows[::2]
        used, rows = np.unique(rows, return_inverse=True)
        ids = self.word_ids([words[i] for i in used])
        lens = np.array([len(x) >> 2 for x in ids], dtype=np.int64)
        flat = gather(np.frombuffer(b"".join(ids), dtype="<u4"), starts(lens), lens, rows)
        first = np.cumsum([0] + [len(t) + 1 for t in coded])
        before = np.concatenate(([0], np.cumsum(lens[rows])))
        return flat, np.diff(before[np.searchsorted(begin, first)])


def word_encoder(tokenizer: str, cached_words: int) -> WordEncoder:
    """The encoder of this Python worker process: Spark uses a process for many tasks."""
    kept = worker_state()
    if tokenizer not in kept:
        kept[tokenizer] = WordEncoder(load_tokenizer(tokenizer), cached_words)
    return kept[tokenizer]


def cut_pieces(docs: DataFrame, text: str, tokenizer: str, capacity: int, end_id: int, keep,
               cached_words: int = CACHED_WORDS, slice_bytes: int = SLICE_BYTES, keep_encoder: bool = True) -> DataFrame:
    """One row per piece, with the task that made it and its number among the task's pieces of
    that length."""
    spec = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("_task", T.IntegerType()), T.StructField("_nth", T.LongType())])

    def pieces(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        encoder = word_encoder(tokenizer, cached_words) if keep_encoder else WordEncoder(load_tokenizer(tokenizer), cached_words)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = int(end_id).to_bytes(4, "little")
        place = len(keep)  # the text is the last column
        for whole in batches:
            column = whole.column(place).fill_null("")
            for lo, hi in slices(pc.binary_length(column).to_pylist(), slice_bytes):
                batch, texts = whole.slice(lo, hi - lo), column.slice(lo, hi - lo).to_pylist()
                flat, lens = encoder.encode(texts)
                row, piece, start, length, crc, nth = [], [], [], [], [], []
                for i, (at, n) in enumerate(zip(starts(lens).tolist(), lens.tolist(), strict=True)):
                    ids = flat[at:at + n].tobytes() + end
                    for k, cut in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[cut:cut + 4 * capacity]
                        size = len(part) // 4
                        row.append(i)
                        piece.append(k)
                        start.append(cut // 4)
                        length.append(size)
                        crc.append(zlib.crc32(part))
                        nth.append(int(seen[size]))
                        seen[size] += 1
                index = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index(c)).take(index) for c in keep]
                    + [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())],
                    names=[*keep, "piece", "start", "length", "ids_crc32", "_task", "_nth"])

    return docs.mapInArrow(tidy(pieces), spec)


def fullest(room: int, counts, lengths) -> dict[int, int]:
    """{length: times} of the fullest combination within ``room``; ``lengths`` descending, with
    ``counts[length]`` available of each."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for n in lengths:
        if n > room:
            continue
        left, part = min(int(counts[n]), room // n), 1
        while left > 0 and not reach >> room & 1:
            take = min(part, left)
            steps.append((n, take, reach))
            reach |= reach << n * take & mask
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    fill, used = reach.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> fill & 1:
            used[n] = used.get(n, 0) + take
            fill -= n * take
    return used


def minimum_bin_slack(counts, capacity: int):
    """Patterns [({length: times}, bins)] that use every piece of the length histogram up."""
    import numpy as np
    counts = np.array(counts, dtype=np.int64)
    lengths = [int(n) for n in np.flatnonzero(counts)[::-1]]
    patterns = []
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        used = fullest(capacity - top, counts, lengths)
        counts[top] += 1
        used[top] = used.get(top, 0) + 1
        bins = min(int(counts[n]) // m for n, m in used.items())
        for n, m in used.items():
            counts[n] -= m * bins
        patterns.append((used, bins))
        lengths = [n for n in lengths if counts[n]]
    return patterns


def slots(patterns):
    """Arrays, ordered by (length, first): pieces of ``length`` numbered from ``first`` on go to the
    ``bins`` sequences from ``base`` on, one after another, and start there at ``at``."""
    import numpy as np
    taken: dict[int, int] = {}
    rows, base = [], 0
    for used, bins in patterns:
        at = 0
        for n, m in sorted(used.items(), reverse=True):
            rows.append((n, taken.get(n, 0), base, bins, at))
            taken[n] = taken.get(n, 0) + m * bins
            at += n * m
        base += bins
    rows.sort()
    return [np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)] or [np.empty(0, dtype=np.int64)] * 5


def best_fit_packing(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY,
                     end_id: int = END_ID, cached_words: int = CACHED_WORDS, slice_bytes: int = SLICE_BYTES,
                     keep_encoder: bool = True) -> DataFrame:
    """One row per piece: the columns of ``docs`` but for the text, then piece, start, length,
    ids_crc32, sequence_id and offset.  A task encodes some ``slice_bytes`` of text at a time, for which it needs some
    fifty times as much memory; ``keep_encoder``: workers keep vocabulary and words' ids for later tasks."""
    keep = [c for c in without(docs, OUTPUTS) if c != text]
    docs = docs.select(*[quoted(c) for c in keep], quoted(text))
    pieces = written(cut_pieces(docs, text, tokenizer, capacity, end_id, keep, cached_words, slice_bytes, keep_encoder), "pieces")
    by_task = pieces.groupBy("_task", "length").agg(F.count("*").alias("n"))
    counts = [0] * (capacity + 1)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``capacity`` rows at most
        counts[r["length"]] = r["n"]
    length, first, base, bins, at = slots(minimum_bin_slack(counts, capacity))
    places = (length << 48) + first
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("_task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("_before"))
    numbered = (pieces.join(offsets, ["_task", "length"])
                .select(*[quoted(c) for c in keep], "piece", "start", "length", "ids_crc32",
                        (F.col("_before") + F.col("_nth")).alias("_number")))
    out = T.StructType([numbered.schema[i] for i in range(len(keep) + 4)]
                       + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("length")).to_numpy()
            k = batch.column(batch.schema.get_field_index("_number")).to_numpy()
            slot = np.searchsorted(places, (n << 48) + k, side="right") - 1
            k = k - first[slot]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(base[slot] + k % bins[slot], pa.int64()),
                 pa.array(at[slot] + k // bins[slot] * n, pa.int64())], names=out.names)

    return numbered.mapInArrow(tidy(place), out)
