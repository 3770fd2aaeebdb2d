"""Near-duplicate classes of documents: similarity of their sets of word shingles at or above a
threshold, found by DartMinHash signatures and banding, checked exactly.

Method (DartMinHash).  A text is a weighted set: its distinct shingles of ``shingle`` words, with weight
1 (``weights="set"``, Jaccard similarity) or their number (``weights="count"``, weighted Jaccard).  Each
unit of weight of an element is a region at which darts are thrown at random, but the same in
every text: the number of darts in a cell of ranks is Poisson, and a dart's rank, height and
coordinate come from its hash.  A dart counts if its height is under the element's weight.  Of each
of ``BANDS * ROWS`` coordinates the dart of least rank is kept.  Ranks are looked at only up to a bound
at which some k ln k + 2k darts are expected in all, so a long text costs one hash per element and
cell and few darts.  Two texts agree in a coordinate with the probability of their similarity.

Joining.  Rows with the same words in the same order are one node, found by a 128-bit hash.  Nodes
that agree in all rows of a band share a bucket (two texts at the threshold share one with a
probability of 0.99997).  No bucket is expanded into pairs: its least node is the *hub*, members are
checked against the hub only (exact similarity), and links join components.  Members that are in one
component by then need no check.  Where members of different components share a bucket, such as
texts that only have a passage in common, they are looked at once more, exactly: by the rarest fifth
of their shingles, of which texts over the threshold share one, while a common passage is not among
them.  Members of such a bucket are looked at two by two, in two passes: first all with some ``HUBS`` of them, which
joins most of what belongs together, then all with one another that are still apart.  A larger bucket is dealt into
blocks, any two of which are a task's work (``cells``).  Only pairs that the sets' sizes and the place of
the shared shingle allow leave a task; they are checked exactly, and components are contracted once a pass.

Results for special inputs: a text of fewer than ``shingle`` words is one shingle; a null text or one
without words is alone in its class; repeated rows are one class; rows with a null key take part and
the class id is the least key that is not null, or null; an empty table gives an empty result; an input
column with the name of an output column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (MADE, M64, drop_intermediates, hash_words, mix64, quoted, split_words, text_column, tidy, unpack,
                     without, write_chunks, written)
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 26, 5
HUBS, CELL = 64, 1024  # rows of a bucket that all others meet first; rows that are looked at as one block
SAMPLE, COMMON = 20_000, 1 << 16  # sets whose elements are counted, and elements known as common
GROUP = 256  # texts signed at once
OUTPUTS = ("class_id", "kept")
EDGES = (0.0, 1 / 64, 1 / 16, 1 / 4, 1.0)  # cells of ranks; cells of width 1 after the last


def poisson_cdf(mean: float):
    import numpy as np
    terms = [math.exp(-mean)]
    while len(terms) < 24:
        terms.append(terms[-1] * mean / len(terms))
    return np.cumsum(terms)


CDF: dict = {}  # by width of the cell


def fraction(h):
    """Uniform in [0, 1) from a 64-bit hash."""
    import numpy as np
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def throw(units, room, lo: float, width: float, cells: int, k: int):
    """Darts at ``units`` (hashes, each open up to height ``room``) in ``cells`` neighbouring cells of ranks
    of ``width`` from ``lo`` on: (index of the unit, ranks, coordinates, dart hashes)."""
    import numpy as np
    if width not in CDF:
        CDF[width] = poisson_cdf(width)
    tag = mix64(((lo + width * np.arange(cells)) * 64 + 1).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    place = mix64(units[:, None] ^ tag[None, :])
    unit, cell = np.nonzero(place >= np.uint64(min(int(CDF[width][0] * 2.0 ** 64), M64)))  # at least one dart
    place = place[unit, cell]
    times = np.maximum(np.searchsorted(CDF[width], fraction(place), side="right"), 1)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    unit, cell = np.repeat(unit, times), np.repeat(cell, times)
    dart = mix64(np.repeat(place, times) + (nth + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    hit = room[unit] >= 1
    some = ~hit
    if some.any():
        hit[some] = fraction(mix64(dart[some] ^ np.uint64(0xA5A5A5A5A5A5A5A5))) < room[unit[some]]
    if not hit.all():
        unit, cell, dart = unit[hit], cell[hit], dart[hit]
    rank = lo + width * (cell + fraction(mix64(dart ^ np.uint64(0x5851F42D4C957F2D))))
    return unit, rank, (mix64(dart ^ np.uint64(0x14057B7EF767814F)) % np.uint64(k)).astype(np.int64), dart


def dart_signatures(elements, weights, sizes, k: int):
    """The dart hash kept in each of ``k`` coordinates (unsigned 64 bit) of many weighted sets, given one
    after another: ``sizes`` elements each, at least one."""
    import numpy as np
    owner = np.repeat(np.arange(len(sizes)), sizes)
    units, room, own = [], [], []
    for layer in range(int(math.ceil(weights.max()))):  # one region per unit of weight
        open_ = weights > layer
        units.append(mix64(elements[open_] + np.uint64(layer * 0x9E3779B97F4A7C15 & M64)))
        room.append(np.minimum(weights[open_] - layer, 1.0))
        own.append(owner[open_])
    units, room, own = np.concatenate(units), np.concatenate(room), np.concatenate(own)
    bound = (k * math.log(k) + 2 * k) / np.bincount(owner, weights, minlength=len(sizes))
    best = np.full(len(sizes) * k, np.inf)
    kept = np.zeros(len(sizes) * k, dtype=np.uint64)
    waiting = np.ones(len(sizes), dtype=bool)
    at = 0
    while True:
        if at < len(EDGES) - 1:
            lo, width, cells = EDGES[at], EDGES[at + 1] - EDGES[at], 1
        else:  # cells of width 1, as many as all sets that wait still need
            lo, width = EDGES[-1] + at - (len(EDGES) - 1), 1.0
            cells = int(min(max(1, math.ceil(bound[waiting].min() - lo)), 1 + (1 << 20) // len(units)))
        at += cells
        unit, rank, coordinate, dart = throw(units, room, lo, width, cells, k)
        place = own[unit] * k + coordinate
        order = np.argsort(-rank, kind="stable")
        place, rank, dart = place[order], rank[order], dart[order]
        first = np.full(len(best), -1, dtype=np.int64)
        first[place] = np.arange(len(place))  # the last written is the least rank
        new = np.flatnonzero((first >= 0) & np.isinf(best))  # cells come in order of rank: earlier ones stay
        best[new], kept[new] = rank[first[new]], dart[first[new]]
        waiting = (bound > lo + width * cells) | np.isinf(best).reshape(-1, k).any(axis=1)
        if not waiting.any():
            return kept.reshape(-1, k)
        still = waiting[own]
        units, room, own = units[still], room[still], own[still]


def shingles(word_hashes, shingle: int):
    """Hash of every ``shingle`` consecutive words; of all words if there are fewer."""
    import numpy as np
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    size = min(n, shingle)
    out = np.full(n - size + 1, size, dtype=np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[j:j + len(out)]
    return mix64(out)


def weighted(hashes, weights: str):
    import numpy as np
    elements, count = np.unique(hashes, return_counts=True)
    return elements, (count if weights == "count" else np.ones(len(elements))).astype(np.float64)


def similarity(a, b) -> float:
    """Jaccard similarity of two ascending sets."""
    import numpy as np
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def signatures(chunks: DataFrame, text: str, key: str, key_type, shingle: int, weights: str) -> DataFrame:
    """(rid, key, k1, k2, bands) of every row; ``bands`` is null for a text without words."""
    spec = T.StructType([T.StructField("rid", T.LongType()), T.StructField("key", key_type),
                         T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                         T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tbl = unpack(blob.as_buffer())
                words, lens = split_words(text_column(tbl, text))
                w = hash_words(words)
                power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(
                    max(0, int(lens.max(initial=0)) - 1), 0x9E3779B97F4A7C15, np.uint64))), dtype=np.uint64)
                k1, k2, sets, end, known = [], [], [], 0, {}
                for n in lens:
                    own, end = w[end:end + n], end + n
                    a = int(mix64((own * power[:n]).sum(dtype=np.uint64) + np.uint64(n)).astype(np.int64))
                    b = int(mix64((mix64(own ^ np.uint64(0xD6E8FEB86659FD93)) * power[:n]).sum(dtype=np.uint64)).astype(np.int64))
                    k1.append(a)
                    k2.append(b)
                    if n and (a, b) not in known:
                        known[a, b] = len(sets)
                        sets.append(weighted(shingles(own, shingle), weights))
                found = []
                for lo in range(0, len(sets), GROUP):
                    some = sets[lo:lo + GROUP]
                    s = dart_signatures(np.concatenate([e for e, _ in some]), np.concatenate([c for _, c in some]),
                                        np.array([len(e) for e, _ in some]), BANDS * ROWS).reshape(-1, BANDS, ROWS)
                    band = np.zeros(s.shape[:2], dtype=np.uint64)
                    for r in range(ROWS):
                        band = mix64(band * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
                    found.extend(band.astype(np.int64).tolist())
                bands = [found[known[a, b]] if n else None for n, a, b in zip(lens, k1, k2, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((chunk << 16) + np.arange(len(lens)), pa.int64()), pa.concat_arrays(tbl.column(key).chunks),
                     pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=spec.names)

    return written(chunks.select("chunk", "blob").mapInArrow(tidy(sign), spec), "signatures")


def shingle_sets(chunks: DataFrame, rids: DataFrame, text: str, shingle: int, weights: str) -> DataFrame:
    """(rid, elements): the shingles of the rows ``rids`` as ascending 32-bit hashes; with
    ``weights="count"`` the second, third, ... of a shingle are elements of their own, so that the
    similarity of the plain sets is the weighted one."""
    wanted = (rids.select(F.shiftright("rid", 16).alias("chunk"), F.col("rid").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("row"))
              .groupBy("chunk").agg(F.collect_list("row").alias("rows")))  # 2^16 rows a chunk at most

    def sets(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for chunk, blob, rows in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                rows = sorted(rows)
                words, lens = split_words(text_column(unpack(blob.as_buffer()).take(rows), text))
                w, end, out = hash_words(words), 0, []
                for n in lens:
                    own, end = w[end:end + n], end + n
                    e, c = weighted(shingles(own, shingle), weights)
                    times = c.astype(np.int64)
                    nth = (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)).astype(np.uint64)
                    e = np.where(nth == 0, np.repeat(e, times), mix64(np.repeat(e, times) + nth * np.uint64(0x9E3779B97F4A7C15)))
                    out.append(np.unique((e >> np.uint64(32)).astype(np.uint32)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(chunk << 16) + r for r in rows], pa.int64()), pa.array(out, pa.binary())], names=["rid", "elements"])

    both = chunks.select("chunk", "blob").join(wanted, "chunk")
    return written(both.mapInArrow(tidy(sets), "rid long, elements binary"), "shingles")


def linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches ``threshold``."""

    def keep(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            good = []
            for ea, eb in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(ea.as_buffer(), np.uint32), np.frombuffer(eb.as_buffer(), np.uint32)
                good.append(min(len(a), len(b)) >= threshold * max(len(a), len(b)) and similarity(a, b) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    a, b = sets.toDF("a", "ea"), sets.toDF("b", "eb")
    return pairs.join(b, "b").join(a, "a").select("a", "b", "ea", "eb").mapInArrow(tidy(keep), "a long, b long")


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(bucket, rid, n, left): the rarest n - ceil(threshold * n) + 1 of each set's n elements, and how many
    elements follow each in the set's order.  Two sets over the threshold share an element there, whatever
    order the elements have; the order (by number in a bounded sample of sets, then hash) only keeps common
    passages out."""
    import numpy as np

    def count(batches):
        import pyarrow as pa
        for batch in batches:
            e, n = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column(0)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(e.astype(np.int64)), pa.array(n.astype(np.int64))], names=["e", "n"])

    sample = sets.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("elements")
    common = (sample.mapInArrow(tidy(count), "e long, n long").groupBy("e").agg(F.sum("n").alias("n")).where("n > 1")
              .orderBy(F.desc("n"), "e").limit(COMMON).collect())  # COMMON rows of two numbers
    common = sorted((r["e"], r["n"]) for r in common)
    known = np.array([e for e, _ in common] + [1 << 32], dtype=np.int64)
    times = np.array([n for _, n in common] + [0], dtype=np.int64)

    def rarest(batches):
        import pyarrow as pa
        for batch in batches:
            rid, out, sizes = [], [], []
            for r, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                e = np.frombuffer(x.as_buffer(), np.uint32).astype(np.int64)
                at = np.searchsorted(known, e)
                order = np.lexsort((e, np.where(known[at] == e, times[at], 0)))
                take = len(e) - math.ceil(threshold * len(e) - 1e-9) + 1
                out.append(e[order[:take]])
                rid.append(r)
                sizes.append(len(e))
            take = np.array([len(x) for x in out])
            n = np.repeat(sizes, take)
            left = n - 1 - (np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out)), pa.array(np.repeat(rid, take)), pa.array(n.astype(np.int32)), pa.array(left.astype(np.int32))],
                names=["bucket", "rid", "n", "left"])

    return sets.mapInArrow(tidy(rarest), "bucket long, rid long, n int, left int")


def cells(pool: DataFrame, size: int, star: bool) -> DataFrame:
    """``pool`` (with ``bucket`` and ``rid``) with ``cell`` and ``own``: a bucket of more than ``size`` rows is dealt into blocks by the
    hash of the row.  Every two blocks are a cell, so that every pair of rows is in one at least and a row in as
    many as there are blocks; with ``star`` only the first block with each, so that every row meets some rows."""
    hot = pool.groupBy("bucket").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks")).where("blocks > 1")
    dealt = pool.join(hot, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("rid", F.lit(3)), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    others = F.when(own == 0, every).otherwise(F.array(F.lit(0))) if star else every
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(others))
    low, high = F.least("own", "other").cast("long"), F.greatest("own", "other")
    return dealt.withColumn("cell", low * F.col("blocks") + high).drop("blocks", "other")


def close_pairs(group, label, n, left, own, threshold: float):
    """Places (i, j) of rows of one group (rows come by group, then size ``n``) that may be over the threshold: of different
    labels, of different blocks or of a group of one block, and allowed by their sizes and the place of the element they
    share, if it is the first one.  Goes through all groups at once, by distance of the places."""
    import numpy as np
    last = np.append(np.flatnonzero(group[1:] != group[:-1]), len(group) - 1)  # of each group
    end = last[np.searchsorted(last, np.arange(len(group)))]
    mixed = np.zeros(len(group), dtype=bool)  # groups of two blocks
    mixed[1:] = (group[1:] == group[:-1]) & (own[1:] != own[:-1])
    mixed = np.add.reduceat(mixed, np.append(0, last[:-1] + 1))[np.searchsorted(last, np.arange(len(group)))] > 0
    most = np.floor(n / threshold + 1e-9)  # a larger set can't reach the threshold
    need = threshold / (1 + threshold)
    i, d, found = np.flatnonzero(end > np.arange(len(group))), 1, []
    while len(i):
        j = i + d
        room = n[j] <= most[i]
        i, j = i[room], j[room]
        good = ((label[i] != label[j]) & (~mixed[i] | (own[i] != own[j]))
                & (1 + np.minimum(left[i], left[j]) >= need * (n[i] + n[j]) - 1e-6))
        found.append((i[good], j[good]))
        d += 1
        i = i[i + d <= end[i]]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def candidates(pool: DataFrame, threshold: float, size: int, star: bool) -> DataFrame:
    """(a, b), a < b: the pairs of rows of a cell of ``pool`` (bucket, rid, label, n, left) that ``close_pairs`` lets through.  Rows
    of a cell come one after another; a task holds a batch and one cell, twice ``size`` rows of a few numbers."""

    def pairs(batches):
        import numpy as np
        import pyarrow as pa
        held = None

        def work(table):
            bucket, cell, rid, label, n, left, own = (c.to_numpy() for c in table.columns)
            group = np.cumsum(np.append(False, (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])))
            i, j = close_pairs(group, label, n, left, own, threshold)
            a, b = rid[i], rid[j]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            bucket, cell = (held.column(i).to_numpy() for i in (0, 1))
            cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1]))
            if len(cut):
                yield work(held.slice(0, cut[-1] + 1))
                held = held.slice(cut[-1] + 1)
        if held is not None:
            yield work(held)

    rows = cells(pool, size, star).select("bucket", "cell", "rid", "label", "n", "left", "own")
    return (rows.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "n", "rid")
            .mapInArrow(tidy(pairs), "a long, b long").distinct())


def near_links(bands: DataFrame, chunks: DataFrame, text: str, shingle: int, weights: str, threshold: float) -> DataFrame:
    """(id, label) of the nodes that have links; ``bands``: (rid, bands) of every node."""
    exploded = bands.select("rid", F.posexplode("bands").alias("j", "v"))
    keyed = exploded.select("rid", F.xxhash64("j", "v").alias("bucket"))
    hubs = keyed.groupBy("bucket").agg(F.min("rid").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    pool = written(keyed.join(hubs, "bucket").where("rid <> hub"), "buckets")
    tested = written(pool.select(F.col("hub").alias("a"), F.col("rid").alias("b")).distinct(), "tested")
    members = pool.select("rid").union(tested.select(F.col("a").alias("rid"))).distinct()
    sets = shingle_sets(chunks, members, text, shingle, weights)
    labels = components(linked(tested, sets, threshold))

    def told_apart(members):
        label = labels.withColumnRenamed("id", "rid")
        return still_apart(members.join(label, "rid", "left").withColumn("label", F.coalesce("label", "rid")))

    rest = written(told_apart(pool.select("bucket", "rid")).select("rid").distinct(), "pool")
    if rest.isEmpty():
        return labels
    shared = prefixes(sets.join(rest, "rid"), threshold)
    for size, star in ((HUBS, True), (CELL, False)):
        pool = written(told_apart(shared), "pool")
        pairs = written(candidates(pool, threshold, size, star).join(tested, ["a", "b"], "left_anti"), "tested")
        labels = components(linked(pairs, sets, threshold), labels)
        tested = tested.unionByName(pairs)
    return labels


def still_apart(told: DataFrame) -> DataFrame:
    """The members (bucket, rid, label) of buckets that hold more than one component."""
    apart = told.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    return told.join(apart, "bucket")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, weights: str = "set", rows: bool = True) -> DataFrame:
    """``docs`` (or with ``rows=False`` its key column only) with class_id, the least key of the row's
    class, and kept, true for one row of each class."""
    keep, before = without(docs, OUTPUTS), len(MADE)
    docs = docs.select(*[quoted(c) for c in keep])
    chunks = write_chunks(docs, text, "near")
    signed = signatures(chunks, text, key, docs.schema[key].dataType, shingle, weights)
    with_words = signed.where("bands IS NOT NULL")
    node = with_words.groupBy("k1", "k2").agg(F.min("rid").alias("node"))
    nodes = written(with_words.select("rid", "key", "k1", "k2").join(node, ["k1", "k2"]).select("rid", "key", "node"), "nodes")
    bands = written(signed.select("rid", "bands").join(nodes.where("rid = node").select("rid"), "rid"), "bands")
    labels = near_links(bands, chunks, text, shingle, weights, threshold)
    classed = nodes.join(labels.withColumnRenamed("id", "node"), "node", "left") \
                   .select("rid", "key", F.coalesce("label", "node").alias("label"))
    alone = signed.where("bands IS NULL").select("rid", "key", F.col("rid").alias("label"))
    classed = written(classed.unionByName(alone), "classes")
    drop_intermediates(docs.sparkSession, before, ("classes", "near") if rows else ("classes",))
    heads = classed.groupBy("label").agg(F.min("key").alias("class_id"),
                                         F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col("rid"))).alias("head"))
    out = classed.join(heads, "label").select("rid", "key", "class_id", (F.col("head.rid") == F.col("rid")).alias("kept"))
    if not rows:
        return out.select(F.col("key").alias(key), "class_id", "kept")
    told = (out.select(F.shiftright("rid", 16).alias("chunk"), F.col("rid").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("row"),
                       "class_id", "kept")
            .groupBy("chunk").agg(F.collect_list(F.struct("row", "class_id", "kept")).alias("told")))  # 2^16 rows at most
    schema = T.StructType([*docs.schema.fields, T.StructField("class_id", docs.schema[key].dataType),
                           T.StructField("kept", T.BooleanType())])

    def back(batches):
        import pyarrow as pa
        for batch in batches:
            for blob, told in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                tbl = unpack(blob.as_buffer())
                told.sort(key=lambda t: t["row"])
                tbl = tbl.append_column("class_id", pa.array([t["class_id"] for t in told], tbl.schema.field(key).type))
                tbl = tbl.append_column("kept", pa.array([t["kept"] for t in told], pa.bool_()))
                yield from tbl.to_batches(max_chunksize=2000)

    return chunks.select("chunk", "blob").join(told, "chunk").select("blob", "told").mapInArrow(tidy(back), schema)
