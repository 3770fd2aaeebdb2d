"""Collocations: phrases of two to three words that occur together more often than their parts let expect.

Texts are lower-cased in A-Z, split at `[.,;:!?]` and line ends into pieces, those into words
`[^\\x20\\x09]+`.  All counts are per ``lang`` (null: ``und``); f is the number of occurrences of one to three
neighbouring words of a piece, overlaps included.

First pass (Misra-Gries).  Tasks cut their texts into blocks of at most ``BLOCK_WORDS`` words, written once
as numbers.  A block's distinct word sequences, with their counts, are sorted by hash and dealt to hash
partitions, as many as keep ``PARTITION_MASS`` occurrences in one.  A partition merges the blocks' counts into
one Misra-Gries summary of more counters than its mass divided by ``least``: what is taken off all
counters on overflow, in all, is under ``least``, so every sequence that occurs ``least`` times is still there.
What can't reach ``least`` with what was taken off is left out.  Two sequences of one hash only keep each other.

Second pass.  A partition answers each block with one bit per sequence sent.  The block counts its survivors
anew by their words, and Spark adds these counts by phrase; what occurs less than ``least`` times goes.  So
results are exact.

Scores are exact integers (decimal arithmetic).  Parts get their counts by one join; adaptive execution
splits a frequent part's rows.  The first ``top`` of a language are found first in 64 parts, then over all.

Results for special inputs: null and empty texts have no words; a very long text goes into many blocks,
neighbouring words of two blocks are seen by the first; repeated rows count each time; ties go by count, then
phrase in byte order; an empty table, or one without a phrase frequent enough, gives an empty result; columns
other than the two named are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MADE, drop_intermediates, hash_words, mix64, quoted, release, tidy, written
from .ragged import distinct, slices

LEAST, TOP, INSIDE = 10, 2000, 50
BITS = 21  # of a word's number in its block
BLOCK_WORDS = (1 << BITS) - 8
AT_ONCE = 1 << 18  # sequences hashed at once
PARTITION_MASS, FEWEST_PARTITIONS = 1 << 23, 64
STEP = 0x9E3779B97F4A7C15
# Bytes that end a piece, and bytes that end a word only.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
BLOCK_SPEC = ("block long, mass long, langs array<string>, totals array<long>, words binary, word_of binary, "
              "lang_of binary, codes binary, breaks binary")


def word_numbers(texts: list[bytes], lang_of_text):
    """(words, code of each word, whether it starts a piece, language number of each)."""
    import numpy as np
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[list(WORD_ENDS)], kinds[list(PIECE_ENDS)] = 1, 2
    data = b"\n".join(t.lower() for t in texts)
    kind = kinds[np.frombuffer(data, dtype=np.uint8)]
    edge = np.diff((kind == 0).astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return [], np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
    # words alternate with what lies between them
    codes, words = distinct(data, np.stack((begin, end), axis=1).ravel())
    piece = np.cumsum(kind == 2, dtype=np.int32 if len(kind) < 1 << 31 else np.int64)[begin]
    first = np.append(0, np.cumsum([len(t) + 1 for t in texts])[:-1])
    return (words, codes[::2].astype(np.int64), np.append(True, piece[1:] != piece[:-1]),
            np.asarray(lang_of_text)[np.searchsorted(first, begin, side="right") - 1])


def block_rows(words, codes, breaks, langs, names, limit: int):
    """Rows of BLOCK_SPEC but for the number: blocks of at most ``limit`` words, each with up to two more words that
    only end what starts before."""
    import numpy as np
    import pyarrow as pa
    for at in range(0, len(codes), limit):
        n = min(limit, len(codes) - at)
        both, unit = np.unique(langs[at:at + n + 2] * len(words) + codes[at:at + n + 2], return_inverse=True)
        lang_of, word = np.divmod(both, len(words))
        used, word_of = np.unique(word, return_inverse=True)
        joined = ~breaks[at:at + n + 2]
        mass = n + int(joined[1:n + 1].sum()) + int((joined[1:n + 1][:len(joined) - 2] & joined[2:n + 2]).sum())
        packed = pa.compress(unit.astype("<i4").tobytes(), codec="zstd", asbytes=True)
        yield {"mass": mass, "langs": names, "totals": np.bincount(langs[at:at + n], minlength=len(names)).tolist(),
               "words": b"\n".join(words[i] for i in used), "word_of": word_of.astype("<i4").tobytes(),
               "lang_of": lang_of.astype("<i4").tobytes(), "breaks": np.packbits(breaks[at:at + n + 2]).tobytes(),
               "codes": n.to_bytes(4, "little") + len(unit).to_bytes(4, "little") + packed}


def cut_blocks(docs: DataFrame) -> DataFrame:
    """Rows of BLOCK_SPEC from (lang, text): a block's words, its units (word and language) and the unit of each
    of its words."""

    def cut(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([("block", pa.int64()), ("mass", pa.int64()), ("langs", pa.list_(pa.string())),
                            ("totals", pa.list_(pa.int64())), ("words", pa.binary()), ("word_of", pa.binary()),
                            ("lang_of", pa.binary()), ("codes", pa.binary()), ("breaks", pa.binary())])
        for batch in batches:
            for lo, hi in slices(pc.binary_length(batch.column(1)).to_pylist()):
                lang = batch.column(0).slice(lo, hi - lo).dictionary_encode()
                numbered = word_numbers(batch.column(1).slice(lo, hi - lo).cast(pa.binary()).to_pylist(),
                                        lang.indices.to_numpy(zero_copy_only=False))
                for row in block_rows(*numbered, lang.dictionary.to_pylist(), BLOCK_WORDS):
                    yield pa.RecordBatch.from_pylist([{"block": number, **row}], schema=schema)
                    number += 1

    return written(docs.mapInArrow(tidy(cut), BLOCK_SPEC), "blocks")


def units_of(keys):
    """Number + 1 of the first, second and third unit of each sequence from the right; 0: none."""
    import numpy as np
    mask = np.uint64((1 << BITS) - 1)
    return [(keys >> np.uint64(BITS * i) & mask).astype(np.int32) for i in (2, 1, 0)]


class Block:
    """A block's distinct word sequences, in order of their hash."""

    def __init__(self, row: dict):
        import numpy as np
        import pyarrow as pa
        self.langs, self.words = row["langs"], row["words"].split(b"\n")
        self.word_of, self.lang_of = np.frombuffer(row["word_of"], "<i4"), np.frombuffer(row["lang_of"], "<i4")
        n, known = (int.from_bytes(row["codes"][i:i + 4], "little") for i in (0, 4))
        unit = np.frombuffer(pa.decompress(row["codes"][8:], 4 * known, codec="zstd"), "<i4").astype(np.uint64) + np.uint64(1)
        joined = np.unpackbits(np.frombuffer(row["breaks"], np.uint8), count=known) == 0
        two = joined[1:n + 1]  # of the word at i with the next
        three = two[:known - 2] & joined[2:n + 2]
        bits = np.uint64(BITS)
        pairs = unit[:len(two)] << bits | unit[1:len(two) + 1]
        keys = np.concatenate((unit[:n], pairs[two], (pairs[:len(three)] << bits | unit[2:len(three) + 2])[three]))
        del unit, pairs, two, three, joined
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.counts = keys[first], np.diff(np.append(first, len(keys))).astype(np.uint32)
        del keys, first
        langs = mix64(hash_words([x.encode() for x in self.langs]))
        of_unit = np.append(np.uint64(0), mix64(hash_words(self.words)[self.word_of] + langs[self.lang_of]))
        self.hashes = np.zeros(len(self.keys), dtype=np.uint64)
        for lo in range(0, len(self.keys), AT_ONCE):
            h = self.hashes[lo:lo + AT_ONCE]
            for part in units_of(self.keys[lo:lo + AT_ONCE]):
                h[:] = mix64(h * np.uint64(STEP) + of_unit[part])
        order = np.argsort(self.hashes)
        for name in ("keys", "counts", "hashes"):
            setattr(self, name, getattr(self, name)[order])

    def phrases(self, chosen):
        """(lang, phrase, number of words) of the sequences ``chosen``."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        units, words = units_of(self.keys[chosen]), pa.array(self.words, pa.binary()).cast(pa.string())
        parts = [words.take(pa.array(self.word_of[np.maximum(u - 1, 0)], mask=u == 0)) for u in units]
        phrase = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
        lang = pa.array(self.langs, pa.string()).take(pa.array(self.lang_of[units[2] - 1]))
        return lang, phrase, np.sum([u > 0 for u in units], axis=0)


def rows_of(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def deal(blocks: DataFrame, bits: int) -> DataFrame:
    """(part, block, keys, counts): a block's sequences of one hash partition of 2^bits, as the next 32 bits of
    their hashes, ascending, with counts (255 for all beyond: enough to survive)."""

    def send(batches):
        import numpy as np
        import pyarrow as pa
        for row in rows_of(batches):
            b = Block(row)
            edges = np.searchsorted(b.hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(b.hashes)]
            keys = (b.hashes >> np.uint64(32 - bits)).astype("<u4")
            counts = np.minimum(b.counts, 255).astype(np.uint8)
            some = [p for p in range(1 << bits) if edges[p] < edges[p + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([row["block"]] * len(some), pa.int64()),
                 pa.array([keys[edges[p]:edges[p + 1]].tobytes() for p in some], pa.binary()),
                 pa.array([counts[edges[p]:edges[p + 1]].tobytes() for p in some], pa.binary())], names=["part", "block", "keys", "counts"])
            del b, keys, counts  # before the next block is built

    return blocks.mapInArrow(tidy(send), "part int, block long, keys binary, counts binary")


def add_up(keys, counts):
    """Each key once, ascending, with the sum of its counts."""
    import numpy as np
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], (np.add.reduceat(counts[order], first) if len(keys) else counts)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters; ``taken`` is the most that any count misses."""

    def __init__(self, capacity: int):
        import numpy as np
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys, counts, taken: int = 0) -> None:
        """Add counts, or another summary's with what it took off."""
        import numpy as np
        self.keys, self.counts = add_up(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts)))
        self.taken += taken
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.taken += off
            left = self.counts > off
            self.keys, self.counts = self.keys[left], self.counts[left] - off

    def survivors(self, least: int):
        """Ascending keys that may occur ``least`` times."""
        return self.keys[self.counts + self.taken >= least]


def answer(dealt: DataFrame, least: int) -> DataFrame:
    """(block, part, kept): for every row of ``deal`` a bit per key, set if its sequence may occur ``least`` times."""

    def judge(table):
        import numpy as np
        import pyarrow as pa
        release()
        keys = [np.frombuffer(x, "<u4") for x in table.column("keys").to_pylist()]
        counts = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
        summary = Summary(sum(int(c.sum(dtype=np.int64)) for c in counts) // least + 1)
        lo = size = 0
        for i, k in enumerate(keys):
            size += len(k)
            if size >= summary.capacity or i + 1 == len(keys):  # as many new counts as the summary has room for
                summary.merge(np.concatenate(keys[lo:i + 1]), np.concatenate(counts[lo:i + 1]).astype(np.int64))
                lo, size = i + 1, 0
        alive = np.append(summary.survivors(least).astype(np.int64), -1)
        kept = [np.packbits(alive[np.searchsorted(alive[:-1], k)] == k).tobytes() for k in keys]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "kept": pa.array(kept, pa.binary())})

    return dealt.groupBy("part").applyInArrow(judge, "block long, part int, kept binary")


def count_survivors(blocks: DataFrame, answers: DataFrame, bits: int, least: int) -> DataFrame:
    """(lang, phrase, words, f) of all sequences that occur ``least`` times, counted exactly."""
    told = answers.groupBy("block").agg(F.collect_list(F.struct("part", "kept")).alias("told"))  # a bit per sequence of a block

    def count(batches):
        import numpy as np
        import pyarrow as pa
        for row in rows_of(batches):
            b = Block(row)
            edges = np.searchsorted(b.hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(b.hashes)]
            chosen = np.zeros(len(b.hashes), dtype=bool)
            for t in row["told"]:
                lo, hi = edges[t["part"]], edges[t["part"] + 1]
                chosen[lo:hi] = np.unpackbits(np.frombuffer(t["kept"], np.uint8), count=hi - lo)
            counts = b.counts[chosen]
            lang, phrase, words = b.phrases(chosen)
            full = pa.RecordBatch.from_arrays([lang, phrase, pa.array(words, pa.int32()), pa.array(counts.astype(np.int64))],
                                              names=["lang", "phrase", "words", "n"])
            for at in range(0, full.num_rows, 1 << 16):
                yield full.slice(at, 1 << 16)
            del b, full, lang, phrase, words, counts  # before the next block is built

    rows = blocks.join(told, "block").mapInArrow(tidy(count), "lang string, phrase string, words int, n long")
    return rows.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("n").alias("f")).where(F.col("f") >= least)


def score_column(left: str, right: str):
    """floor(1000000 a a / (l r)), exactly; never over 1000000."""
    wide = "DECIMAL(38,0)"
    return F.expr(f"(CAST(a AS {wide}) * CAST(a AS {wide}) * 1000000) div (CAST({left} AS {wide}) * CAST({right} AS {wide}))")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of all phrases of two and three words, by their worst cut."""
    phrases = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def part(n: int, start: int, length: int):
        return F.struct(F.lit(n).alias("n"), F.array_join(F.slice("w", start, length), " ").alias("part"))

    two = F.array(part(0, 1, 1), part(1, 2, 1))
    three = F.array(part(0, 1, 1), part(1, 2, 2), part(2, 1, 2), part(3, 3, 1))
    parts = phrases.select("lang", "phrase", "words", "a", F.explode(F.when(F.col("words") == 2, two).otherwise(three)).alias("p"))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("pf"))
    sides = (parts.select("lang", "phrase", "words", "a", "p.n", "p.part").join(known, ["lang", "part"])
             .groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.first("a").alias("a"),
                                            *[F.max(F.when(F.col("n") == i, F.col("pf"))).alias(f"p{i}") for i in range(4)]))
    cuts = sides.withColumn("s1", score_column("p0", "p1")).withColumn("s2", score_column("p2", "p3"))
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    return cuts.select("lang", "phrase", "words", "a", F.when(second, F.col("p2")).otherwise(F.col("p0")).alias("l"),
                       F.when(second, F.col("p3")).otherwise(F.col("p1")).alias("r"),
                       F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))


def without_parts(phrases: DataFrame, counts: DataFrame, inside: int) -> DataFrame:
    """``phrases`` but for those inside a longer one with at least ``inside`` percent of their occurrences."""
    w = F.split("phrase", " ")
    longer = (counts.where("words = 3")
              .select("lang", "f", F.explode(F.array_distinct(F.array(F.array_join(F.slice(w, 1, 2), " "), F.array_join(F.slice(w, 2, 2), " ")))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("most")))
    return phrases.join(longer, ["lang", "phrase"], "left").where((F.col("most").isNull()) | (100 * F.col("most") < inside * F.col("a"))).drop("most")


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int | None = TOP,
                 inside: int = INSIDE) -> DataFrame:
    """Each language's first ``top`` phrases (None: all): lang, rank, phrase, a, l, r, n, score."""
    spark, before = docs.sparkSession, len(MADE)
    docs = docs.select(F.coalesce(quoted(lang), F.lit("und")).alias("lang"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    blocks = cut_blocks(docs)
    mass = blocks.agg(F.sum("mass")).first()[0] or 0
    bits = max(FEWEST_PARTITIONS - 1, mass // PARTITION_MASS).bit_length()
    answers = written(answer(deal(blocks, bits), least), "answers")
    counts = written(count_survivors(blocks, answers, bits, least), "counts")
    totals = written(blocks.select(F.explode(F.arrays_zip("langs", "totals")).alias("t"))
                     .groupBy(F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("n")), "totals")
    drop_intermediates(spark, before, ("counts", "totals"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = without_parts(scored(counts), counts, inside)
    if top is not None:  # the first of 64 parts of a language, then of all
        salt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
        found = found.withColumn("_nth", F.row_number().over(salt)).where(F.col("_nth") <= top).drop("_nth")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    if top is not None:
        found = found.where(F.col("rank") <= top)
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
