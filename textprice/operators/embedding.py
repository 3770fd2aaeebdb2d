"""Word vectors by skip-gram with negative sampling, the vocabulary in shards (no word list on the driver).

A word's two vectors (as a centre, as a context) are a row of a table hash-partitioned by word.  Rows of
tokens are dealt to groups by a hash of their content; a group is what one task trains on or embeds at a time.
In each round

1. a group's distinct words ask the table for their vectors: one join by word, one exchange to the group.  A word
   not in the table yet starts with vectors made from its hash, the same everywhere;
2. each group trains on its texts with its own copies, in numpy: for a run of tokens the products of all centres
   with all contexts are one matrix product, of which the band within the window counts; negatives are
   drawn from the group's own tokens (count to the power 3/4), the same for a run;
3. the changes of a word's vectors in all groups, weighted by its number there, are averaged by one aggregate
   and written as the next table.

Documents are embedded the same way: the rows are written once (a text that is still to be cleaned is cleaned once, and
their size is known), their words' vectors come to the group, a row's vector is the mean of its
words'.  Nothing is collected; a task holds the vectors of one group's distinct words.  ``groups`` (by default one for
``GROUP_BYTES`` of tokens, and on small inputs one for each core) sets that size: a word's vectors travel once to every group
that has it, so larger groups move less.  The rows' own columns deal them out, so copies of a text
under different keys go to different groups.  The last round keeps no context vectors, which nothing reads.

Results for special inputs: null or no tokens give the zero vector; a word that no training text had is left out of the
mean (all words unknown: zero vector); repeated rows have equal vectors; an empty table trains an empty vocabulary.
"""

from __future__ import annotations

import threading

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasMaxIter, HasOutputCol, HasSeed, HasStepSize
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete, exchanges_dropped, scratch_path

RUN = 128  # tokens that are trained at once
STRIP = 32  # centres whose products with their contexts are one matrix
NEGATIVES = 64  # drawn for a run
GROUP_BYTES = 16 << 20  # of tokens in a group, whose distinct words' vectors a task holds
LEAST_BYTES = 1 << 20  # a smaller group doesn't pay
EMBED_BYTES = 32 << 20  # of tokens in a group that is embedded, which takes half the memory for a word
LONGEST = 0.25  # change of a vector by one run
WEIGHTS = "word string, n long, centre binary, context binary"
ATOMIC = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.BooleanType, T.BinaryType, T.ArrayType)


def start_vectors(words, size: int, seed: int):
    """Centre vectors of words before any training, uniform within ±0.5 / size, from their hashes."""
    import numpy as np
    import pandas as pd
    words = words.to_pylist() if hasattr(words, "to_pylist") else words
    h = pd.util.hash_array(np.array([w.encode() for w in words], dtype=object), categorize=False)
    x = h[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # a public 64-bit finaliser
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / size


def train_group(rows, centre, context, window: int, rate: float, seed: int):
    """Skip-gram over the rows (lists of word numbers): changes ``centre`` and ``context`` in place.  A run's centres are cut
    into strips, whose products are taken with the strip's own contexts only: those of the strip and ``window`` on either side."""
    import numpy as np
    rng = np.random.default_rng(seed)
    tokens = np.concatenate(rows).astype(np.int32)
    text = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    noise = np.bincount(tokens, minlength=len(centre)) ** 0.75
    noise = np.cumsum(noise / noise.sum())
    step = RUN - window  # the last words of a run come again, as contexts, in the next
    starts, size = range(0, len(tokens), step), centre.shape[1]
    draws = np.searchsorted(noise, rng.random((len(starts), NEGATIVES))).clip(max=len(centre) - 1).astype(np.int32)

    strips, wide = RUN // STRIP, STRIP + 2 * window
    i = np.arange(RUN).reshape(strips, STRIP, 1)  # places of centres in the run, of contexts
    j = (np.arange(strips)[:, None] * STRIP + np.arange(wide) - window)[:, None, :]
    band = (i != j) & (np.abs(i - j) <= window) & (j >= 0) & (j < RUN)
    unseen = band & ~((i < window) & (j < window))  # pairs wholly among the repeated words have been seen
    v, around, own = np.zeros((RUN, size), np.float32), np.zeros((RUN + 2 * window, size), np.float32), np.full(RUN + 2 * window, -1, np.int32)
    at_strip = lambda x: np.lib.stride_tricks.as_strided(x, (strips, wide, *x.shape[1:]), (STRIP * x.strides[0], *x.strides))
    vs, us, own_i, own_j = v.reshape(strips, STRIP, size), at_strip(around), own[window:window + RUN].reshape(strips, STRIP, 1), at_strip(own)[:, None, :]
    pulled = np.zeros_like(around)
    for n, at in enumerate(starts):
        run, drawn = tokens[at:at + RUN], draws[n]
        k = len(run)
        pairs = unseen if at else band
        if k < RUN or text[at] != text[at + k - 1]:
            own[window:window + k], own[window + k:] = text[at:at + k], -1
            pairs = pairs & (own_i == own_j) & (i < k)
        v[:k], v[k:] = centre.take(run, axis=0), 0
        around[window:window + k], around[window + k:] = context.take(run, axis=0), 0
        away = -context.take(drawn, axis=0)
        now = np.float32(rate * max(1 - n * step / len(tokens), 0.1))
        weight = pairs.sum(axis=2, dtype=np.float32).reshape(-1)[:k] * (now / np.float32(NEGATIVES) * 5)  # five negatives for a pair
        pull = falling(np.matmul(vs, us.transpose(0, 2, 1)), now)
        pull *= pairs
        push = falling(v[:k] @ away.T, weight[:, None])
        push *= run[:, None] != drawn
        change = np.matmul(pull, us).reshape(RUN, size)[:k]
        change += push @ away
        pulled[:] = 0
        for s, part in enumerate(np.matmul(pull.transpose(0, 2, 1), vs)):
            pulled[s * STRIP:s * STRIP + wide] += part
        add_rows(centre, run, change)
        add_rows(context, np.concatenate((run, drawn)), np.concatenate((pulled[window:window + k], -(push.T @ v[:k]))))


def falling(x, top):
    """top / (1 + exp(x)), in place."""
    import numpy as np
    np.maximum(x, -30, out=x)
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(top, x, out=x)


def add_rows(table, rows, change) -> None:
    """Add the changes to the rows of a table; one row's, summed over its places, by ``LONGEST`` at most: places of one run
    don't see each other's changes, so that a frequent word's sum would overshoot."""
    import numpy as np
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    own, total = rows[first], change.take(order[first], axis=0)
    if len(own) < len(rows):
        count = np.concatenate((first[1:], [len(rows)])) - first
        more, n = np.flatnonzero(count > 1), 1
        while len(more):  # the second places of all rows, the third ...
            if n == 8:  # few rows have more
                rest = [order[first[m] + n:first[m] + count[m]] for m in more]
                ends = np.cumsum(count[more] - n)
                total[more] += np.add.reduceat(change.take(np.concatenate(rest), axis=0), ends - (count[more] - n), axis=0)
                break
            total[more] += change.take(order[first[more] + n], axis=0)
            n += 1
            more = more[count[more] > n]
    length = np.einsum("ij,ij->i", total, total)
    if length.max(initial=0) > LONGEST * LONGEST:
        total *= np.minimum(1, LONGEST / np.sqrt(np.maximum(length, 1e-24)))[:, None]
    total += table.take(own, axis=0)
    table[own] = total


def token_bytes(tokens: str):
    """Aggregate: size of all tokens, one separator for each."""
    return F.coalesce(F.sum((F.octet_length(F.array_join(tokens, "")) + F.size(tokens)).cast("long")), F.lit(0))


def group_number(spark: SparkSession, size: int) -> int:
    """Groups for ``size`` bytes of tokens."""
    return max(1, -(-size // GROUP_BYTES), min(spark.sparkContext.defaultParallelism, size // LEAST_BYTES))


def ordered(df: DataFrame) -> DataFrame:
    """``df`` with ``_order``, a hash of the row's content."""
    plain = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, ATOMIC)]
    return df.withColumn("_order", F.xxhash64(*plain))


def grouped(rows: DataFrame, groups: int) -> DataFrame:
    return rows.withColumn("_group", F.pmod("_order", F.lit(groups)).cast("int"))


_THREAD = threading.local()


def rows_written() -> list[str]:
    """Paths of the rows that this thread wrote to embed them, oldest first."""
    return _THREAD.__dict__.setdefault("paths", [])


def drop_rows(spark: SparkSession, since: int) -> None:
    """Delete the rows that this thread wrote after the first ``since`` ones; no result may read them any more."""
    for path in rows_written()[since:]:
        delete(spark, path)
    del rows_written()[since:]


BETWEEN, MARK = "\x1f", "\x1e"  # between joined tokens; before what stands for something else


def joined(tokens: str):
    """The tokens as one string, which exchanges, files and Arrow take in a fraction of an array's space; null for null."""
    plain = F.array_join(tokens, "")
    marked = F.transform(tokens, lambda t: F.replace(F.replace(t, F.lit(MARK), F.lit(MARK + "0")), F.lit(BETWEEN), F.lit(MARK + "1")))
    return F.when(F.size(tokens) == 0, F.lit(MARK + "3")) \
        .when(plain.contains(MARK) | plain.contains(BETWEEN), F.array_join(marked, BETWEEN, MARK + "2")) \
        .otherwise(F.array_join(tokens, BETWEEN, MARK + "2"))


def separated(strings):
    """(lengths, numbers, words) of an Arrow array of joined tokens: the lists' lengths, their tokens as numbers of ``words``,
    an Arrow array of different words, and among them at most one null."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    lists = pc.split_pattern(strings, BETWEEN)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    told = lists.flatten().dictionary_encode()
    numbers, words = told.indices.to_numpy(zero_copy_only=False).astype(np.int64), told.dictionary
    if pc.any(pc.match_substring(words, MARK)).as_py():
        said = words.to_pylist()
        if MARK + "3" in said:
            none = numbers == said.index(MARK + "3")
            lengths[np.repeat(np.arange(len(lengths)), lengths)[none]] = 0
            numbers = numbers[~none]
        words = pa.array([None if w in (MARK + "2", MARK + "3") else w.replace(MARK + "1", BETWEEN).replace(MARK + "0", MARK) for w in said], pa.string())
    return lengths, numbers, words


def matrix(vectors, size: int):
    """The vectors of an Arrow array of binaries, of which none is null, as a matrix."""
    import numpy as np
    ends = np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset:vectors.offset + len(vectors) + 1]
    return np.frombuffer(vectors.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.float32).reshape(-1, size)


def binaries(vectors):
    """The rows of a matrix as an Arrow array of binaries."""
    import numpy as np
    import pyarrow as pa
    flat = np.ascontiguousarray(vectors, dtype=np.float32)
    ends = np.arange(len(flat) + 1, dtype=np.int32) * (flat.shape[1] * 4)
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def dealt(rows: DataFrame, groups: int, *order) -> DataFrame:
    """More partitions than groups, so that few tasks have two; adaptive execution would join small ones, whose work is not small."""
    return rows.repartition(max(groups, min(4 * groups, 512)), "_group").sortWithinPartitions("_group", *order)


def with_vectors(words: DataFrame, rows: DataFrame, weights: DataFrame | None, known: bool, groups: int, *order) -> DataFrame:
    """Each group's words (_group, word) with their vectors, then its rows: (_group, word, centre, context, the rows' columns).
    ``known``: only words of the table, else all (without vectors if new)."""
    if weights is None:
        words = words.withColumn("centre", F.lit(None).cast("binary")).withColumn("context", F.lit(None).cast("binary"))
    else:
        words = words.join(weights.select("word", "centre", "context"), "word", "inner" if known else "left") \
            .select("_group", "word", "centre", "context")
    columns = [c for c in rows.columns if c not in ("_group", "_order")]
    # Spark's Arrow writer goes back to the last list that isn't null, at every row: words' rows have empty ones
    lists = {f.name: F.array().cast(f.dataType) for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType)}
    both = words.withColumns(lists).unionByName(rows, allowMissingColumns=True)
    return dealt(both, groups, F.col("word").isNull(), *order).select("_group", "word", "centre", "context", *columns)


def by_group(batches, on_group):
    """Go through batches whose first column is the group: ``on_group(batches)`` for every group's, whose results are passed on."""
    now, own = None, []
    for batch in batches:
        group = batch.column(0).to_numpy()
        edges = [0, *((group[1:] != group[:-1]).nonzero()[0] + 1).tolist(), len(group)] if len(group) else [0]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if now is not None and group[lo] != now:
                yield from on_group(own)
                own = []
            now = group[lo]
            own.append(batch.slice(lo, hi - lo))
    if own:
        yield from on_group(own)


def words_first(batches, size: int, contexts: bool):
    """(words, has, centres, contexts, rows) of a group's batches: an Arrow array, whether a word has vectors, those that there
    are, and the batches of rows."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    words, has, vectors, rows = [], [], ([], []) if contexts else ([],), []
    while batches:
        batch = batches.pop(0)
        is_word = pc.is_valid(batch.column(1))
        some = batch.filter(is_word)
        if some.num_rows:
            words.append(some.column(1))
            there = pc.is_valid(some.column(2))
            has.append(there.to_numpy(zero_copy_only=False))
            for place, out in enumerate(vectors, 2):
                out.append(matrix(some.column(place).filter(there), size).copy())
        rest = batch.filter(pc.invert(is_word))
        if rest.num_rows:
            rows.append(rest.select(batch.schema.names[4:]))
    whole = [np.concatenate(v) if v else np.zeros((0, size), np.float32) for v in vectors]
    return pa.concat_arrays(words) if words else pa.array([], pa.string()), np.concatenate(has) if has else np.zeros(0, bool), *whole, rows


def numbered(strings, words):
    """Word numbers of each row's tokens; unknown and null tokens are left out.  ``words`` is an Arrow array."""
    import numpy as np
    import pyarrow.compute as pc
    lengths, numbers, said = separated(strings)
    place = pc.fill_null(pc.index_in(said, value_set=words, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return known_only(lengths, place[numbers])


def known_only(lengths, numbers):
    """The rows' numbers without those under 0."""
    import numpy as np
    there = numbers >= 0
    ends = np.concatenate(([0], np.cumsum(there)))[np.cumsum(lengths)]
    return np.split(numbers[there], ends[:-1]) if len(lengths) else []


def train_round(df: DataFrame, tokens: str, weights: DataFrame | None, size: int, window: int, rate: float, seed: int,
                groups: int, last: bool, only: DataFrame | None = None) -> DataFrame:
    """The next table of weights; ``last``: without context vectors."""

    def changed(words, texts, centre, context):
        import numpy as np
        import pyarrow as pa
        count = np.bincount(np.concatenate(texts), minlength=len(words))
        train_group(texts, centre, context, window, rate, seed)
        for lo in range(0, len(words), 4096):
            some = slice(lo, lo + 4096)
            yield pa.RecordBatch.from_arrays(
                [words[some], pa.array(count[some], pa.int64()), binaries(centre[some]),
                 pa.nulls(len(words[some]), pa.binary()) if last else binaries(context[some])], names=["word", "n", "centre", "context"])

    def train_first(batches):
        """Without a table, a group's words are those of its rows."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        lengths, numbers, words = separated(pa.concat_arrays([b.column(1) for b in batches]))
        batches.clear()
        order = pc.sort_indices(words, sort_keys=[("", "descending")], null_placement="at_end").to_numpy()
        order = order[:len(words) - words.null_count]
        if not len(order):
            return
        place = np.full(len(words), -1)
        place[order] = np.arange(len(order))
        words = words.take(pa.array(order))
        centre = start_vectors(words, size, seed)
        yield from changed(words, known_only(lengths, place[numbers]), centre, np.zeros_like(centre))

    def train_next(batches):
        import numpy as np
        import pyarrow as pa
        words, has, old_centre, old_context, rows = words_first(batches, size, True)
        if not len(words):
            return
        centre, context = np.zeros((2, len(words), size), dtype=np.float32)
        new = np.flatnonzero(~has)
        if len(new):
            centre[new] = start_vectors(words.take(pa.array(new)), size, seed)
        centre[has], context[has] = old_centre, old_context
        del old_centre, old_context
        yield from changed(words, [t for b in rows for t in numbered(b.column(0), words)], centre, context)

    def merge(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        held = None  # the last word so far, which the next batch may go on with

        def table(words, n, sums):
            means = [binaries(x / n[:, None]) for x in sums]
            return pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64()), means[0], pa.nulls(len(words), pa.binary()) if last else means[1]],
                                              names=["word", "n", "centre", "context"])

        for batch in batches:
            if not batch.num_rows:
                continue
            words, k = batch.column(0), batch.column(1).to_numpy()
            first = np.flatnonzero(np.concatenate(([True], pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False))))
            sums = [np.add.reduceat(matrix(batch.column(i), size).astype(np.float64) * k[:, None], first, axis=0) for i in ((2,) if last else (2, 3))]
            words, n = words.take(pa.array(first)), np.add.reduceat(k, first)
            if held is not None:
                if held[0][0].as_py() == words[0].as_py():
                    n[0] += held[1][0]
                    for x, y in zip(sums, held[2], strict=True):
                        x[0] += y[0]
                else:
                    yield table(*held)
            if len(words) > 1:
                yield table(words[:-1], n[:-1], [x[:-1] for x in sums])
            held = words[-1:], n[-1:], [x[-1:].copy() for x in sums]
        if held is not None:
            yield table(*held)

    rows = grouped(ordered(df), groups)
    texts = rows.select("_group", "_order", joined(tokens).alias("_tokens"))
    if weights is None and only is None:
        told = dealt(texts, groups, "_order").select("_group", "_tokens").mapInArrow(lambda batches: by_group(batches, train_first), WEIGHTS)
    else:
        words = rows.select("_group", F.explode(tokens).alias("word")).where("word IS NOT NULL").distinct()
        if only is not None:
            words = words.join(only, "word", "left_semi").select("_group", "word")
        told = with_vectors(words, texts, weights, False, groups, F.desc_nulls_last("word"), "_order") \
            .mapInArrow(lambda batches: by_group(batches, train_next), WEIGHTS)
    # a word's changes in all groups, weighted by its number there, in the order of their content
    return told.repartition("word").sortWithinPartitions("word", "n", F.xxhash64("centre", "context")).mapInArrow(merge, WEIGHTS)


def fit_word_vectors(df: DataFrame, tokens: str, size: int = 100, window: int = 5, rounds: int = 1, rate: float = 0.025,
                     groups: int | None = None, seed: int = 42, min_count: int = 0, least: int = 1) -> str:
    """Train on ``tokens`` (array of words) without words of fewer than ``min_count`` places; the path of the written
    table (word, n, centre, context).  ``df`` is read more than once."""
    spark = df.sparkSession
    groups = groups or max(least, group_number(spark, df.agg(token_bytes(tokens)).first()[0]))
    only = df.select(F.explode(tokens).alias("word")).groupBy("word").count().where(F.col("count") >= min_count).select("word") \
        if min_count > 1 else None
    weights, path = None, None
    for i in range(rounds):
        before, path = path, scratch_path(spark, f"word-vectors-{i}")
        with exchanges_dropped(spark):
            train_round(df, tokens, weights, size, window, rate * (1 - i / rounds), seed + i, groups, i == rounds - 1, only).write.parquet(path)
        weights = spark.read.schema(WEIGHTS).parquet(path)
        if before:
            delete(spark, before)
    return path


def flat(df: DataFrame, columns: list[str]):
    """``df`` with struct columns (vectors are such) as a column for each field and one for null, and a function that puts a
    batch's columns together again.  Spark measures every row that goes to Python, and a struct column anew from its first
    row on: that grows with the square of a batch."""
    plan, plain = [], []
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType
        col = F.col("`" + c.replace("`", "``") + "`")
        inner = kind.sqlType() if isinstance(kind, T.UserDefinedType) else kind
        if not isinstance(inner, T.StructType) or not inner.fields:
            plan.append((None, 1))
            plain.append(col)
            continue
        base = F.unwrap_udt(col) if inner is not kind else col
        plan.append((inner.names, 1 + len(inner)))
        plain.append(base.isNull().alias(f"_{i}_null"))
        plain.extend(base.getField(f).alias(f"_{i}_{j}") for j, f in enumerate(inner.names))

    def together(arrays):
        import pyarrow as pa
        out, at = [], 0
        for names, width in plan:
            if at == len(arrays):
                break
            if names is None:
                out.append(arrays[at])
            else:
                out.append(pa.StructArray.from_arrays(list(arrays[at + 1:at + width]), names=list(names), mask=arrays[at]))
            at += width
        return out

    return df.select(*plain), together


def embed_tokens(df: DataFrame, tokens: str, weights: DataFrame, out: str, size: int, groups: int | None = None) -> DataFrame:
    """``df`` with ``out`` (array of doubles): the mean of the row's word vectors.

    The rows are written once, in their own tasks, in groups of ``EMBED_BYTES`` of tokens one after another; behind a group's rows
    stand its distinct words, which are read alone to fetch their vectors."""
    columns, spark = [c for c in df.columns if c != out], df.sparkSession
    path, kept = scratch_path(spark, "rows-to-embed"), [c for c in columns if c != tokens]
    rows, together = flat(df.select(*kept, joined(tokens).alias("_tokens")), [*kept, "_tokens"])
    spec = T.StructType([T.StructField("_group", T.LongType()), T.StructField("word", T.StringType()), T.StructField("_bytes", T.LongType()),
                         *(T.StructField(f.name, f.dataType) for f in rows.schema)])

    def deal(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 32
        number, held, words = first, 0, []

        def close(names, types):
            own = pc.unique(pa.concat_arrays(words)).drop_null() if words else pa.array([], pa.string())
            told = np.zeros(max(len(own), 1), np.int64)
            told[0] = held  # the group's size, with its first word
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(told), number)), own if len(own) else pa.nulls(1, pa.string()), pa.array(told),
                                               *(pa.nulls(len(told), t) for t in types)], names=["_group", "word", "_bytes", *names])

        names = types = None
        for batch in batches:
            names, types = batch.schema.names, batch.schema.types
            texts = batch.column(batch.num_columns - 1)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            lo = 0
            while lo < batch.num_rows:
                before = ends[lo - 1] if lo else 0
                hi = min(int(np.searchsorted(ends, before + EMBED_BYTES - held)) + 1, batch.num_rows)
                words.append(separated(texts[lo:hi])[2])
                held += int(ends[hi - 1] - before)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(hi - lo, number)), pa.nulls(hi - lo, pa.string()), pa.nulls(hi - lo, pa.int64()),
                                                  *batch.slice(lo, hi - lo).columns], names=["_group", "word", "_bytes", *names])
                lo = hi
                if held >= EMBED_BYTES:
                    yield close(names, types)
                    number, held, words = number + 1, 0, []
        if held:
            yield close(names, types)

    with exchanges_dropped(spark):
        rows.mapInArrow(deal, spec).write.option("compression", "zstd").parquet(path)
    rows_written().append(path)
    stored = spark.read.schema(spec).parquet(path)
    words = stored.where("_bytes IS NOT NULL").select("_group", "word", "_bytes")
    made, total = words.agg(F.count_distinct("_group"), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    words, rows = words.where("word IS NOT NULL").drop("_bytes"), stored.where("_bytes IS NULL").drop("word", "_bytes")
    least = groups or max(spark.sparkContext.defaultParallelism, -(-2 * total // EMBED_BYTES))
    if made > 4 * least or groups and made > groups:  # many small partitions: theirs together
        joint = F.pmod(F.xxhash64("_group"), F.lit(least))
        words, rows, made = words.select(joint.alias("_group"), "word").distinct(), rows.withColumn("_group", joint), least
    sent = [c for c in rows.columns if c != "_group"]
    spec = T.StructType([*(df.schema[c] for c in columns), T.StructField(out, T.ArrayType(T.DoubleType()))])
    place = columns.index(tokens)

    def embed(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        words, _, vectors, rows = words_first(batches, size, False)
        for batch in rows:
            *others, texts = batch.columns
            lengths, numbers, said = separated(texts)
            own = pc.fill_null(pc.index_in(said, value_set=words, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            means = [vectors.take(t, axis=0).mean(axis=0, dtype=np.float64) if len(t) else np.zeros(size) for t in known_only(lengths, own[numbers])]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(means) + 1) * size, pa.int32()), pa.array(np.concatenate(means)))
            back = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), said.take(pa.array(numbers)),
                                            mask=pc.is_null(texts))
            arrays = together(others)
            yield pa.RecordBatch.from_arrays([*arrays[:place], back, *arrays[place:], lists], names=[*columns, out])

    weights = weights.select("word", "centre", F.lit(None).cast("binary").alias("context"))
    return with_vectors(words, rows.select("_group", *sent), weights, True, max(made, 1)).mapInArrow(lambda batches: by_group(batches, embed), spec)


class _Shared(HasInputCol, HasOutputCol, HasMaxIter, HasSeed, HasStepSize):
    vectorSize = Param(Params._dummy(), "vectorSize", "length of a word's vector", TypeConverters.toInt)
    windowSize = Param(Params._dummy(), "windowSize", "words on either side that are contexts", TypeConverters.toInt)
    groups = Param(Params._dummy(), "groups", "groups of rows; 0: by the size of the tokens", TypeConverters.toInt)
    leastGroups = Param(Params._dummy(), "leastGroups", "groups in training at least, if they are by size", TypeConverters.toInt)
    minCount = Param(Params._dummy(), "minCount", "words of fewer places are left out", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(vectorSize=100, windowSize=5, groups=0, maxIter=1, stepSize=0.025, seed=42, minCount=0, leastGroups=1,
                         inputCol="tokens", outputCol="embedding")


class _ModelWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.weights().write.mode("overwrite").parquet(f"{path}/weights")


class _ModelReader(MLReader):
    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ShardedWord2VecModel(f"{path}/weights")
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model




class ShardedWord2VecModel(_Shared, Model, MLWritable, MLReadable):
    """Word vectors as a pipeline stage; saved with its table of weights."""

    def __init__(self, path: str = ""):
        super().__init__()
        self.path = path

    def weights(self) -> DataFrame:
        return SparkSession.active().read.schema(WEIGHTS).parquet(self.path)

    def getVectors(self) -> DataFrame:
        """(word, vector) of the whole vocabulary, distributed."""
        size = self.getOrDefault(self.vectorSize)

        def floats(batches):
            import numpy as np
            import pyarrow as pa
            for b in batches:
                flat = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).astype(np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * size, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["word", "vector"])

        return self.weights().select("word", "centre").mapInArrow(floats, "word string, vector array<double>")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        size = self.getOrDefault(self.vectorSize)
        rows = embed_tokens(dataset, self.getInputCol(), self.weights(), out, size, self.getOrDefault(self.groups) or None)
        # the size is told, so that an assembler needn't embed rows to see it in the first
        return rows.withColumn(out, array_to_vector(out).alias(out, metadata={"ml_attr": {"num_attrs": size}}))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class ShardedWord2Vec(_Shared, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Skip-gram word vectors with the vocabulary in shards, as a pipeline stage."""

    @keyword_only
    def __init__(self, *, vectorSize=100, windowSize=5, maxIter=1, stepSize=0.025, seed=42, groups=0, minCount=0, leastGroups=1,
                 inputCol="tokens", outputCol="embedding"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ShardedWord2VecModel:
        g = self.getOrDefault
        path = fit_word_vectors(dataset, self.getInputCol(), g(self.vectorSize), g(self.windowSize), self.getMaxIter(),
                                self.getStepSize(), g(self.groups) or None, self.getSeed(), g(self.minCount), g(self.leastGroups))
        return self._copyValues(ShardedWord2VecModel(path))
