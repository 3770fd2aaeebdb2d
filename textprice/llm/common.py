"""Shared helpers: tables, written intermediates, packed chunks of documents, 64-bit mixing.

**Words** are the maximal runs of characters other than the six ASCII white-space characters
(space, tab, line feed, vertical tab, form feed, carriage return), unchanged.

**Chunks.**  Several operators need to come back to a text after an exchange of facts about its
words.  ``write_chunks`` packs whole rows into compressed blobs of about ``chunk_bytes`` of text
(a longer text is a chunk of its own) and writes them once to the shared folder, so that every
later pass, and any retried task, sees the same chunk under the same id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 2 << 20
M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


MADE: list[str] = []  # paths of the intermediate tables of this process, oldest first


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses neither recompute it
    nor depend on the executors that made it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    MADE.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths) -> None:
    """Delete intermediate tables that no result needs any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        if path in MADE:
            MADE.remove(path)


def drop_intermediates(spark: SparkSession, since: int, keep=()) -> None:
    """Delete the tables written after the first ``since`` ones, but for those named in ``keep``: the caller's
    result does not read them."""
    remove(spark, [p for p in MADE[since:] if p.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in keep])


def spread(df: DataFrame) -> DataFrame:
    """Nothing for a table with many splits; a table of few splits (tests, small inputs) is dealt
    out round-robin so that Python work uses all cores.  Only for scans."""
    spark = df.sparkSession
    n = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def without(df: DataFrame, names) -> list[str]:
    """Columns of ``df`` that an operator passes through: all but those it makes itself."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def write_chunks(docs: DataFrame, text: str, name: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (chunk, rows, raw_bytes, blob): ``docs`` packed in input order, each chunk closed when
    its texts reach ``chunk_bytes`` or it has 2^16 rows.  ``blob`` is an Arrow stream of all columns.
    ``chunk`` < 2^47, so that chunk * 2^16 + row numbers every row."""

    def pack(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 24
        state = {"n": 0, "parts": [], "rows": 0, "size": 0}

        def flush():
            t = pa.Table.from_batches(state["parts"]).combine_chunks()
            sink = pa.BufferOutputStream()
            opts = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
            with pa.ipc.new_stream(sink, t.schema, options=opts) as w:
                w.write_table(t)
            out = pa.RecordBatch.from_arrays(
                [pa.array([first + state["n"]], pa.int64()), pa.array([state["rows"]], pa.int64()),
                 pa.array([state["size"]], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["chunk", "rows", "raw_bytes", "blob"])
            state.update(n=state["n"] + 1, parts=[], rows=0, size=0)
            return out

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
            at = 0
            for i, b in enumerate(sizes.to_pylist()):
                state["size"] += b
                state["rows"] += 1
                if state["size"] >= chunk_bytes or state["rows"] >= 1 << 16:
                    state["parts"].append(batch.slice(at, i + 1 - at))
                    at = i + 1
                    yield flush()
            if at < batch.num_rows:
                state["parts"].append(batch.slice(at))
        if state["rows"]:
            yield flush()

    return written(docs.mapInArrow(tidy(pack), "chunk long, rows long, raw_bytes long, blob binary"), name)


def worker_state() -> dict:
    """A dictionary of this Python process, for what is costly to load and the same in every task."""
    import sys
    import types
    return sys.modules.setdefault("_textprice_worker", types.ModuleType("_textprice_worker")).__dict__


def release() -> None:
    """Give back to the system what this Python process has freed: Spark keeps its workers for later tasks and
    stages, and their allocators keep what the largest task before needed."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(task):
    """The function ``task`` over a task's batches, in a worker that holds no memory of tasks before or after."""

    def run(batches):
        release()
        try:
            yield from task(batches)
        finally:
            release()

    return run


def unpack(blob: bytes):
    """The rows of one chunk, as a pyarrow Table."""
    import pyarrow as pa
    with pa.ipc.open_stream(blob) as r:
        return r.read_all().combine_chunks()


def text_column(tbl, name: str) -> list:
    """Texts of a chunk as Python strings; null is the empty text."""
    return ["" if x is None else x for x in tbl.column(name).to_pylist()]


def split_words(texts) -> tuple[list[bytes], "object"]:
    """All words of the texts, one after another, and the number of words of each text."""
    import numpy as np
    words: list[bytes] = []
    lens = np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        w = t.encode("utf-8", "surrogatepass").split()
        lens[i] = len(w)
        words.extend(w)
    return words, lens


def hash_words(words):
    """64-bit hash of each word (SipHash with a fixed key: the same in every process)."""
    import numpy as np
    import pandas as pd
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    arr = np.empty(len(words), dtype=object)
    arr[:] = words
    return pd.util.hash_array(arr, categorize=False)


def mix64(x):
    """Bijective finaliser on unsigned 64-bit integers (the public splitmix64 constants)."""
    import numpy as np
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
