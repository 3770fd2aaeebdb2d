"""Document fingerprints from closed syncmers, and the likeness of texts by their fingerprints.

Method.  Every substring of ``S`` code points gets a rolling hash.  A substring of ``K`` code points is
a closed syncmer if the smallest of its inner hashes is its first or its last: a choice made by the
substring alone, whatever stands around it.  So equal passages of two texts give equal anchors, at
places that differ by the passages' shift.  An anchor is (position, hash of the ``K`` code points).

``K`` - 1 marks stand before and after a text, so that it has substrings of ``K`` at all its ends and no length is a
special one.  Substrings of marks alone have the smallest hash, so the first 1, 2, ... ``K`` - ``S`` code points and
the last ones are always anchors: texts of any length that begin or end alike share some, and only the empty
text has none.

The fingerprint is all distinct anchor hashes (32 bits each, as hex) with the place of each one's first
anchor (counted from the first mark), so it grows with the text, and the likeness of two fingerprints is the
Jaccard similarity of the anchor sets, whatever the lengths of the texts.  Matched by position, a common anchor
counts if the common anchor before or after it has the same shift: passages that moved together, also by different
shifts.  With a given ``size`` only the ``size`` smallest hashes are kept, and the likeness is the
share of the ``size`` smallest of the union that both hold, an estimate of the same.

``next`` documents are found without one global sort task: documents are cut into id ranges of about
equal size; the first document of each range is added to the range before it as a closing row (of the
first range: to the last one), and every range is read once, in order, holding one text at a time.  Texts
are compressed before they are dealt out.

Results for special inputs: a null text is the empty text; an empty text has the empty fingerprint;
two empty fingerprints are alike (1), an empty and another one are not (0); null ids come first and
rows of one id follow the order of their texts' beginnings, then of their hashes; a single document is its own next; an empty table
gives an empty result; an input column with the name of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, quoted, without

K = 16
S = 5
MARK = 0x110000  # one above the code points
SIZE = 128  # of a sketch, for callers that want fingerprints of bounded size
HEAD = 32  # code points of a text that order rows of one id
BASE = 0x9E3779B97F4A7C15
OUTPUTS = ("n_chars", "edited_text", "fingerprint", "edited_fingerprint", "positions", "edited_positions", "near_edited", "near_next",
           "aligned_edited", "aligned_next")


def rolled(codes, width: int):
    """Hash (mod 2^64) of every ``width`` consecutive code points."""
    import numpy as np
    out = np.zeros(len(codes) - width + 1, dtype=np.uint64)
    for j in range(width):
        out = out * np.uint64(BASE) + codes[j:j + len(out)]
    return mix64(out)


def sliding_least(x, width: int):
    """Smallest of every ``width`` consecutive values, by doubling."""
    import numpy as np
    span, n = 1, len(x) - width + 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


def closed_syncmers(text: str, k: int = K, s: int = S):
    """(positions, 64-bit hashes) of the anchors of a text; the first ones begin before it."""
    import numpy as np
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    marks = np.full(k - 1, MARK, dtype=np.uint64)
    codes = np.concatenate((marks, codes, marks))
    inner = rolled(codes, s)
    inner[:k - s] = inner[len(inner) - (k - s):] = 0  # of marks alone
    least = sliding_least(inner, k - s + 1)
    at = np.flatnonzero((inner[:len(least)] == least) | (inner[k - s:] == least))
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(BASE) + codes[at + j]
    return at - (k - 1), mix64(out)


def placed(text: str, k: int = K, s: int = S, size: int | None = None):
    """Distinct 32-bit anchor hashes, ascending (the ``size`` smallest, if given), and the place of each
    one's first anchor, from the first mark on."""
    import numpy as np
    at, hashes = closed_syncmers(text, k, s)
    hashes, first = np.unique((hashes >> np.uint64(32)).astype(np.uint32), return_index=True)
    return hashes[:size], (at[first][:size] + (k - 1)).astype(np.uint32)


def fingerprint(text: str, k: int = K, s: int = S, size: int | None = None):
    return placed(text, k, s, size)[0]


def likeness(a, b, size: int | None = None) -> float:
    import numpy as np
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    twice = both[1:] == both[:-1]
    if size is not None and size in (len(a), len(b)):  # beyond a full fingerprint's last hash it says nothing
        distinct = np.concatenate(([True], ~twice))
        kept = min(size, int(distinct.sum()))
        last = both[distinct][kept - 1]
        return float((both[1:][twice] <= last).sum() / kept)
    return float(twice.sum() / (len(both) - twice.sum()))


def aligned(a, b) -> float:
    """Share of the anchors of both (as of ``placed``) that are common and shifted like a common one next to them."""
    import numpy as np
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    here, there = a[1][i].astype(np.int64), b[1][j].astype(np.int64)
    order = np.argsort(here, kind="stable")
    shift = there[order] - here[order]
    same = shift[1:] == shift[:-1]
    kept = (np.append(same, False) | np.append(False, same)).sum()
    return float(kept / (len(a[0]) + len(b[0]) - len(common)))


def hex_of(hashes) -> str:
    return hashes.astype(">u4").tobytes().hex()


def anchors(docs: DataFrame, text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``docs`` with ``anchors``: array of (position, hash), the closed syncmers of the whole text."""
    keep = without(docs, ["anchors"])
    docs = docs.select(*[quoted(c) for c in keep])
    kind = T.ArrayType(T.StructType([T.StructField("position", T.LongType()), T.StructField("hash", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("anchors", kind)])

    def find(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        kind = to_arrow_schema(schema).field("anchors").type
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                found = []
                for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                    at, h = closed_syncmers(t or "", k, s)
                    found.append([{"position": int(p), "hash": int(x)} for p, x in zip(at, h.astype(np.int64), strict=True)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=schema.names)

    return docs.mapInArrow(find, schema)


def in_ranges(docs: DataFrame, text: str, order: str) -> DataFrame:
    """``docs`` without the text, but with _range, _order, _end (0; 1 for the closing row of a range), _null
    (whether the text is), _text compressed and its length in bytes, in order."""
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    others = [f for f in docs.schema.fields if f.name != text]
    base = docs.select(*[quoted(f.name) for f in others], quoted(text).isNull().alias("_null"),
                       F.coalesce(quoted(order).cast("long"), F.lit(-(1 << 63))).alias("_order"),
                       F.coalesce(quoted(text), F.lit("")).alias("_text"))
    ranges = 4 * tasks
    marks = base.agg(F.percentile_approx("_order", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0]
    marks = sorted(set(marks or []))
    # number of marks <= _order, by binary search: one step per power of two
    steps = [1 << i for i in range(len(marks).bit_length() - 1, -1, -1)] if marks else []
    if marks:
        found = F.aggregate(F.lit(steps), F.lit(0), lambda lo, step: F.when(
            (lo + step <= len(marks)) & (F.get(F.lit(marks), lo + step - 1) <= F.col("_order")), lo + step).otherwise(lo))
    else:
        found = F.lit(0)
    base = base.withColumn("_range", found.cast("int"))
    heads = sorted((r["_range"], r["o"]) for r in
                   base.groupBy("_range").agg(F.min("_order").alias("o")).collect())  # a row per range
    closes = [(o, heads[i - 1][0]) for i, (_, o) in enumerate(heads)]  # the first closes the last
    small = spark.createDataFrame(closes, "_order long, _closes int")  # a row per range
    tie = F.struct(F.substring("_text", 1, HEAD).alias("h"), F.xxhash64("_text").alias("x"), F.col("_text").alias("t"))
    least = (base.join(F.broadcast(small), "_order").groupBy("_order", "_closes").agg(F.min(tie)["t"].alias("_text")))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in others]
    closing = least.select(*empty, F.lit(False).alias("_null"), "_order", "_text", F.col("_closes").alias("_range"), F.lit(1).alias("_end"))
    rows = (base.withColumn("_end", F.lit(0)).unionByName(closing)
            .withColumn("_head", F.substring("_text", 1, HEAD)).withColumn("_hash", F.xxhash64("_text")))
    keep = [c for c in rows.columns if c != "_text"]
    packed = T.StructType([rows.schema[c] for c in keep] + [T.StructField("_size", T.LongType()), T.StructField("_text", T.BinaryType())])

    def pack(batches):
        import pyarrow as pa
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in batch.column(batch.schema.get_field_index("_text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array([len(t) for t in raw], pa.int64()),
                 pa.array([codec.compress(t, asbytes=True) for t in raw], pa.binary())], names=packed.names)

    return (rows.mapInArrow(pack, packed).repartition(tasks, "_range")
            .sortWithinPartitions("_range", "_end", "_order", "_head", "_hash"))


def fingerprint_with_next(docs: DataFrame, text: str = "text", order: str = "doc_id",
                          k: int = K, s: int = S, size: int | None = None) -> DataFrame:
    """``docs`` with n_chars, fingerprint, the edited text (its last floor(n / 2) code points replaced by
    the first as many of the next document), edited_fingerprint, the positions of both fingerprints, and
    the likeness of the text to the edited and the next text: near_... by sets, aligned_... by position."""
    keep = without(docs, [*OUTPUTS, "_range", "_order", "_end", "_null", "_text", "_head", "_hash", "_size"])
    docs = docs.select(*[quoted(c) for c in keep])
    schema = T.StructType([*docs.schema.fields, T.StructField("n_chars", T.LongType()),
                           T.StructField("edited_text", T.StringType()), T.StructField("fingerprint", T.StringType()),
                           T.StructField("edited_fingerprint", T.StringType()),
                           T.StructField("positions", T.StringType()), T.StructField("edited_positions", T.StringType()),
                           T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
                           T.StructField("aligned_edited", T.DoubleType()), T.StructField("aligned_next", T.DoubleType())])

    def walk(batches):
        import pyarrow as pa
        codec, held = pa.Codec("zstd"), None  # (its columns, text, fingerprint, range), waiting for the next row of its range
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                ranges = batch.column(batch.schema.get_field_index("_range")).to_pylist()
                ends = batch.column(batch.schema.get_field_index("_end")).to_pylist()
                texts = [codec.decompress(t, n, asbytes=True).decode("utf-8", "surrogatepass") if n else "" for t, n in zip(
                    batch.column(batch.schema.get_field_index("_text")).to_pylist(),
                    batch.column(batch.schema.get_field_index("_size")).to_pylist(), strict=True)]
                gone = batch.column(batch.schema.get_field_index("_null")).to_pylist()
                own = pa.RecordBatch.from_arrays([
                    pa.array([None if g else t for t, g in zip(texts, gone, strict=True)], pa.string()) if c == text
                    else batch.column(batch.schema.get_field_index(c)) for c in keep], names=keep)
                parts, out = [], []
                for i, (r, end, t) in enumerate(zip(ranges, ends, texts, strict=True)):
                    f = placed(t, k, s, size)
                    if held is not None:
                        row, before, g, place = held
                        if place != r:
                            raise RuntimeError("a range of documents has no closing row")
                        half = len(before) // 2
                        edited = before[:len(before) - half] + t[:half]
                        e = placed(edited, k, s, size)
                        with_edited, with_next = ((likeness(g[0], x[0], size), aligned(g, x)) for x in (e, f))
                        parts.append(row)
                        out.append((len(before), edited, hex_of(g[0]), hex_of(e[0]), hex_of(g[1]), hex_of(e[1]),
                                    with_edited[0], with_next[0], with_edited[1], with_next[1]))
                    held = None if end else (own.slice(i, 1), t, f, r)
                if out:
                    rows = pa.Table.from_batches(parts).combine_chunks()
                    kinds = [pa.int64(), *[pa.string()] * 5, *[pa.float64()] * 4]
                    made = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0)
                         for c in range(len(keep))] + made, names=schema.names)

    return in_ranges(docs, text, order).select(*[quoted(c) for c in keep if c != text], "_null", "_range", "_end", "_size", "_text").mapInArrow(walk, schema)
