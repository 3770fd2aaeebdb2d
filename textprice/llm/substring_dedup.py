"""Substring de-duplication: every window of ``width`` consecutive words that also starts anywhere
else (same text included) is removed wherever it occurs.

Method.  A Rabin-Karp hash is rolled over the word hashes of each text, for every window.  Windows
are counted in Spark: each chunk of documents sends every *distinct* window hash once, packed into
one binary row per hash bucket; a bucket sees the hashes of all chunks and answers with one bit per
hash (held by another chunk too).  So a window that occurs in a third of all documents reaches its
bucket at most once per chunk, and an exchanged window costs eight bytes.  The bucket is chosen by
a second, independent Rabin-Karp hash, hence two different windows are confused only if 64 bits
and the bucket agree: the more data, the more buckets, the more bits.  Back at the text,
overlapping repeated windows are merged into maximal removal intervals.

Results for special inputs: null and empty texts have no words, nothing is removed and the kept
text is empty; a text shorter than ``width`` words is kept; repeated rows are different places, so
their windows are repeats; an empty table gives an empty result; an input column with the name of
an output column is replaced by the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_words, mix64, quoted, release, split_words, text_column, tidy, unpack, without, write_chunks

WIDTH = 35
BUCKET_WINDOWS = 1 << 20
OUTPUTS = ("n_words", "n_removed", "removed_spans", "kept_text")


def window_hashes(word_hashes, width: int, base: int):
    """Rabin-Karp hash (mod 2^64) of every ``width`` consecutive word hashes: h(i) = sum of
    w[i + j] * base^j, rolled through prefix sums."""
    import numpy as np
    n = len(word_hashes)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    power = np.full(n, base, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    back = np.full(n - width + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(word_hashes * power, out=total[1:], dtype=np.uint64)
    return (total[width:] - total[:n - width + 1]) * back


def distinct_windows(texts, width: int, buckets: int):
    """Of one chunk: its words, words per text, start places of all windows, the distinct window
    hashes dealt by bucket (hashes, bucket bounds), and for each window its index there and
    whether it occurs more than once in the chunk."""
    import numpy as np
    words, lens = split_words(texts)
    w = hash_words(words)
    first = np.concatenate(([0], np.cumsum(lens)))
    starts = np.arange(max(0, len(w) - width + 1), dtype=np.int64)
    if len(starts):
        left = np.repeat(first[1:], lens)[:len(starts)] - starts  # words to the end of the text
        starts = starts[left >= width]
    h1 = mix64(window_hashes(w, width, 0x9E3779B97F4A7C15)[starts])
    h2 = mix64(window_hashes(mix64(w ^ np.uint64(0xD6E8FEB86659FD93)), width, 0xC2B2AE3D27D4EB4F)[starts])
    keys, at, place, count = np.unique(h1, return_index=True, return_inverse=True, return_counts=True)
    bucket = (h2[at] >> np.uint64(16)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    new = np.empty(len(order), dtype=np.int64)
    new[order] = np.arange(len(order))
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    return words, lens, starts, keys[order], bounds, new[place], count[place] > 1


def covered(starts, repeated, n_words: int, width: int):
    """Mask of the words that some repeated window covers."""
    import numpy as np
    delta = np.zeros(n_words + 1, dtype=np.int64)
    hit = starts[repeated]
    np.add.at(delta, hit, 1)
    np.add.at(delta, hit + width, -1)
    return np.cumsum(delta[:-1]) > 0


def repeated_bits(chunks: DataFrame, text: str, width: int, buckets: int) -> DataFrame:
    """(chunk, bucket, bits): for the distinct windows that a chunk holds in a bucket, in order,
    whether another chunk holds them too.  Only rows with a bit set."""

    def send(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, _, _, keys, bounds, _, _ = distinct_windows(text_column(unpack(blob.as_buffer()), text), width, buckets)
                full = np.flatnonzero(bounds[1:] > bounds[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), pa.array(np.full(len(full), chunk), pa.int64()),
                     pa.array([keys[bounds[b]:bounds[b + 1]].tobytes() for b in full], pa.binary())],
                    names=["bucket", "chunk", "hashes"])

    def count(tbl):
        import numpy as np
        import pyarrow as pa
        release()
        sizes = np.array([len(x.as_buffer()) // 8 for x in tbl.column("hashes")], dtype=np.int64)
        h = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in tbl.column("hashes")])
        order = np.argsort(h)
        s = h[order]
        same = s[1:] == s[:-1]
        flag = np.zeros(len(h), dtype=bool)
        flag[order[1:][same]] = True
        flag[order[:-1][same]] = True
        ends = np.cumsum(sizes)
        parts = [flag[e - n:e] for e, n in zip(ends, sizes, strict=True)]
        some = [i for i, p in enumerate(parts) if p.any()]
        return pa.table({"chunk": tbl.column("chunk").take(pa.array(some, pa.int64())),
                         "bucket": tbl.column("bucket").take(pa.array(some, pa.int64())),
                         "bits": pa.array([np.packbits(parts[i]).tobytes() for i in some], pa.binary())})

    sent = chunks.select("chunk", "blob").mapInArrow(tidy(send), "bucket long, chunk long, hashes binary")
    return sent.groupBy("bucket").applyInArrow(count, "chunk long, bucket long, bits binary")


def substring_dedup(docs: DataFrame, text: str = "text", width: int = WIDTH,
                    bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_removed, removed_spans (maximal [start, end) word intervals) and
    kept_text (the kept words joined by one space)."""
    keep = without(docs, OUTPUTS)
    if text not in keep:
        raise ValueError(f"text column {text!r} has the name of an output column")
    docs = docs.select(*[quoted(c) for c in keep])
    chunks = write_chunks(docs, text, "windows")
    size = chunks.agg(F.sum("raw_bytes")).first()[0] or 0
    buckets = 1 + size // (6 * bucket_windows)  # about six bytes a word
    bits = (repeated_bits(chunks, text, width, buckets)
            .groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")))
    # one answer per bucket at most: bounded by the windows of the chunk
    both = chunks.select("chunk", "blob").join(bits, "chunk", "left").select("blob", "answers")
    schema = T.StructType(list(docs.schema.fields) + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed_spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept_text", T.StringType())])

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(schema)
        for batch in batches:
            for blob, answers in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                tbl = unpack(blob.as_buffer())
                words, lens, starts, keys, bounds, place, twice = distinct_windows(text_column(tbl, text), width, buckets)
                flag = np.zeros(len(keys), dtype=bool)
                for a in answers or ():
                    lo, hi = bounds[a["bucket"]], bounds[a["bucket"] + 1]
                    flag[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).astype(bool)
                gone = covered(starts, twice | flag[place], len(words), width)
                ends = np.cumsum(lens)
                removed, spans, kept = [], [], []
                for e, n in zip(ends, lens, strict=True):
                    g = gone[e - n:e]
                    k = int(g.sum())
                    removed.append(k)
                    if k == 0:
                        spans.append([])
                        kept.append(b" ".join(words[e - n:e]))
                        continue
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                    kept.append(b" ".join([words[e - n + i] for i in np.flatnonzero(~g)]))
                out = tbl.append_column("n_words", pa.array(lens, pa.int64()))
                out = out.append_column("n_removed", pa.array(removed, pa.int64()))
                out = out.append_column("removed_spans", pa.array(spans, target.field("removed_spans").type))
                out = out.append_column("kept_text", pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()))
                yield from out.to_batches(max_chunksize=2000)

    return both.mapInArrow(tidy(cut), schema)
