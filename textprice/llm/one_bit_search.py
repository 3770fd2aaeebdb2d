"""Approximate nearest neighbours by randomly rotated one-bit codes, reranked on the vectors.

Method.  Vectors are taken relative to their mean, scaled to length 1, rotated by one random
orthogonal matrix and kept as the signs of their coordinates: one bit each, packed into 64-bit
words.  Two correction scalars go with a code: the vector's distance from the mean, and the inner
product of the vector with its own code.  A query is rotated alike and cut into eight bit planes;
its inner product with a code is then a sum of population counts over packed words, and dividing
by the correction scalar gives an unbiased estimate of the inner product with the vector, with an
error of at most ``CONFIDENCE`` standard bounds sqrt((1 - c^2) / c^2 / (D - 1)) plus the planes'
rounding.  A vector is compared exactly only if the least distance within its bound does not exceed
the distance of the query's k-th nearest so far.

Every row is indexed, with a number of its own; the index is written once.  Queries are a stated set, taken in
blocks of about ``BLOCK``, the bound of what the driver holds and a task is given: a block's nearest rows are
written before the next block is read.  A task keeps k rows per query and the best k of all
tasks are chosen by a window per query over at most k rows per task.

Results for special inputs: null and zero vectors and vectors that hold a null or non-finite component
neither search nor are found; vectors are compared with those of their own dimension; a row is not
found by its own query; each row of a repeated id is a row of its own, found by the others' queries; ties go to the
smaller id; fewer candidates than k are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import quoted, written

BLOCK = 4096
CONFIDENCE = 3.0
SEED = 20240229
PLANES = 8


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part, components as doubles."""
    v = quoted(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(quoted(key).isNotNull() & F.coalesce(finite, F.lit(False)))
            .where(F.exists(v, lambda x: x != 0)).select(quoted(key).alias("id"), v.alias("v")))


def means(rows: DataFrame) -> dict:
    """Mean vector by dimension, from per-task sums (one row per dimension and component)."""

    def sums(batches):
        import numpy as np
        import pyarrow as pa
        total: dict = {}
        for batch in batches:
            for x in by_dimension(batch)[1].values():
                s, n = total.get(x.shape[1], (0, 0))
                total[x.shape[1]] = (s + x.sum(axis=0), n + len(x))
        for d, (s, n) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array(s, pa.float64()),
                 pa.array(np.full(d, n), pa.int64())], names=["d", "i", "s", "n"])

    import numpy as np
    out: dict = {}
    for r in (rows.select("id", "v").mapInArrow(sums, "d int, i int, s double, n long")
              .groupBy("d", "i").agg((F.sum("s") / F.sum("n")).alias("m")).collect()):
        out.setdefault(r["d"], np.zeros(r["d"]))[r["i"]] = r["m"]
    return out


def by_dimension(batch):
    """({dimension: ids}, {dimension: matrix}) of a batch with columns id, v."""
    import numpy as np
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    out_ids, out = {}, {}
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        out_ids[int(d)] = ids[at]
        out[int(d)] = flat[first[at][:, None] + np.arange(d)]
    return out_ids, out


def rotation(d: int, seed: int = SEED):
    import numpy as np
    q, r = np.linalg.qr(np.random.default_rng([seed, d]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def pack_signs(positive):
    """Boolean [n, d] -> unsigned 64-bit words [n, ceil(d / 64)]."""
    import numpy as np
    n, d = positive.shape
    padded = np.zeros((n, -(-d // 64) * 64), dtype=bool)
    padded[:, :d] = positive
    return np.packbits(padded, axis=1).view(np.uint64)


def encode(x, mean, turn):
    """Codes, distances from the mean, and inner products of each unit vector with its code."""
    import numpy as np
    r = (x - mean) @ turn
    far = np.sqrt((r * r).sum(axis=1))
    unit = r / np.where(far > 0, far, 1)[:, None]
    own = np.abs(unit).sum(axis=1) / np.sqrt(x.shape[1])
    return pack_signs(unit > 0), far, np.where(far > 0, own, 1.0)


class QueryBlock:
    """Rotated bit planes of a block of queries of one dimension."""

    def __init__(self, rows, ids, x, mean, turn):
        import numpy as np
        self.rows, self.ids, self.x, self.d = rows, ids, x, x.shape[1]
        r = (x - mean) @ turn
        self.far = np.sqrt((r * r).sum(axis=1))
        unit = r / np.where(self.far > 0, self.far, 1)[:, None]
        self.low = unit.min(axis=1)
        self.step = np.maximum((unit.max(axis=1) - self.low) / (2 ** PLANES - 1), 1e-12)
        level = np.rint((unit - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rest = unit - self.low[:, None] - level * self.step[:, None]
        self.rounding = np.sqrt((rest * rest).sum(axis=1))
        self.total = level.sum(axis=1)
        self.planes = [pack_signs((level >> p & 1).astype(bool)) for p in range(PLANES)]

    def least_distances(self, q: int, codes, far, own, ones):
        """Estimated squared distances of query ``q`` to coded vectors, and their lower bounds."""
        import numpy as np
        count = np.zeros(len(codes), dtype=np.int64)
        for p, plane in enumerate(self.planes):
            count += np.bitwise_count(codes & plane[q]).sum(axis=1, dtype=np.int64) << p
        # sign sum of a vector u over a code: 2 * (sum of u where the bit is set) - (sum of u)
        signed = self.low[q] * (2 * ones - self.d) + self.step[q] * (2 * count - self.total[q])
        cosine = signed / np.sqrt(self.d) / own
        slack = (CONFIDENCE * np.sqrt(np.maximum(1 - own * own, 0) / max(self.d - 1, 1)) + self.rounding[q]) / own
        base, scale = far * far + self.far[q] ** 2, 2 * far * self.far[q]
        return base - scale * cosine, base - scale * (cosine + slack)


def distances(x, q):
    """Euclidean distances, squares added in order of the components."""
    import numpy as np
    d = x - q
    return np.sqrt(np.cumsum(d * d, axis=1)[:, -1])


def build_index(vectors: DataFrame, key: str, vector: str, seed: int = SEED):
    """(index table: id, v, d, code, far, own, row; means by dimension)."""
    rows = usable(vectors, key, vector)
    mean = means(rows)
    turn = {d: rotation(d, seed) for d in mean}

    def codes(batches):
        import pyarrow as pa
        for batch in batches:
            ids, groups = by_dimension(batch)
            for d, x in groups.items():
                code, far, own = encode(x, mean[d], turn[d])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[d], pa.int64()), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([d] * len(x), pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array(far, pa.float64()), pa.array(own, pa.float64())],
                    names=["id", "v", "d", "code", "far", "own"])

    index = rows.mapInArrow(codes, "id long, v binary, d int, code binary, far double, own double")
    return written(index.withColumn("row", F.monotonically_increasing_id()), "one-bit-index"), mean, turn


def nearest(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
            block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each query row.  ``is_query``: condition
    on the integer column ``id``."""
    import numpy as np
    index, mean, turn = build_index(vectors, key, vector, seed)
    wanted = index.where(is_query)
    blocks = max(1, -(-wanted.count() // block))
    spec = T.StructType([T.StructField("_query", T.LongType()), T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                         T.StructField("score", T.DoubleType())])

    def searcher(queries: list[QueryBlock]):
        def search(batches):
            import pyarrow as pa
            best = {b.d: ([np.empty(0)] * len(b.ids), [np.empty(0, np.int64)] * len(b.ids)) for b in queries}
            for batch in batches:
                ids = batch.column(0).to_numpy()
                dims = batch.column(2).to_numpy()
                for b in queries:
                    at = np.flatnonzero(dims == b.d)
                    if not len(at):
                        continue
                    x = np.frombuffer(b"".join(batch.column(1).take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), b.d)
                    codes = np.frombuffer(b"".join(batch.column(3).take(pa.array(at)).to_pylist()), np.uint64).reshape(len(at), -1)
                    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
                    far, own, own_ids = batch.column(4).to_numpy()[at], batch.column(5).to_numpy()[at], ids[at]
                    own_rows = batch.column(6).to_numpy()[at]
                    dist, found = best[b.d]
                    for q in range(len(b.ids)):
                        guess, least = b.least_distances(q, codes, far, own, ones)
                        other = own_rows != b.rows[q]
                        guess[~other] = least[~other] = np.inf
                        d, i = dist[q], found[q]
                        if len(d) < k:
                            tried = np.argpartition(guess, min(k, len(guess)) - 1)[:k]
                            tried = tried[other[tried]]
                            near = np.sort(np.concatenate((d, distances(x[tried], b.x[q]))))
                            worst = near[k - 1] if len(near) >= k else np.inf
                        else:
                            worst = d[-1]
                        tried = np.flatnonzero(other & (least <= worst * worst * (1 + 1e-9) + 1e-12))
                        if not len(tried):
                            continue
                        d, i = np.concatenate((d, distances(x[tried], b.x[q]))), np.concatenate((i, own_ids[tried]))
                        top = np.lexsort((i, d))[:k]
                        dist[q], found[q] = d[top], i[top]
            for b in queries:
                dist, found = best[b.d]
                n = [len(x) for x in dist]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(b.rows, n), pa.int64()), pa.array(np.repeat(b.ids, n), pa.int64()), pa.array(np.concatenate(found), pa.int64()),
                     pa.array(np.concatenate(dist), pa.float64())], names=spec.names)
        return search

    order = Window.partitionBy("_query").orderBy("score", "vec_id")
    path = scratch_path(vectors.sparkSession, "one-bit-nearest")
    for number in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).select("id", "d", "v", "row").collect()  # about ``block``
        queries = []
        for d in sorted({r["d"] for r in rows}):
            own = [r for r in rows if r["d"] == d]
            x = np.frombuffer(b"".join(bytes(r["v"]) for r in own), np.float64).reshape(-1, d)
            queries.append(QueryBlock(np.array([r["row"] for r in own]), np.array([r["id"] for r in own]), x, mean[d], turn[d]))
        found = index.mapInArrow(searcher(queries), spec).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.mode("overwrite").parquet(f"{path}/block={number}")
    return vectors.sparkSession.read.parquet(path).drop("block")
