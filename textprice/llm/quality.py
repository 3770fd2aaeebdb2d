"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot products.

Features of a text: its words and word pairs, and the *forms* of its words (runs of lower-case
letters, capitals and digits shortened to one sign, other characters kept) and form pairs, where a
pair also says whether both words are the same.  All four kinds are hashed into ``2 ** bits``
weights; a feature's value is its share of the text's words times ``SCALE``.  Nothing but the text
is read.

Training uses a bounded sample: the ``max_examples`` labelled documents of smallest hash, ordered
by that hash, in one task (a documented limit of the fit; every document is scored).  The weights
have a fixed size.

Results for special inputs: null and empty texts have no features and get the score of the bias
alone; without training labels every weight is 0 and every score 0.5; labels of a document given
more than once count as the greatest; a training document given more than once is used once, with
its least text; null labels and labels of absent documents are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_words, mix64, quoted, split_words, tidy, without

BITS = 18
SCALE = 10.0
MAX_EXAMPLES = 20_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
THRESHOLD = 0.3
OUTPUTS = ("score", "predicted")


def form_of(word: bytes) -> bytes:
    """``Thhaen`` -> ``Aa``, ``THE!!`` -> ``A!``, ``ond###`` -> ``a#``; signs beyond ASCII are letters."""
    out, last = bytearray(), -1
    for c in word:
        c = 97 if c >= 128 or 97 <= c <= 122 else 65 if 65 <= c <= 90 else 57 if 48 <= c <= 57 else c
        if c != last:
            out.append(c)
            last = c
    return bytes(out)


def features(texts, bits: int):
    """(indices [4, words], first place of each text, words per text): the hashed features of all
    words, one after another."""
    import numpy as np
    import pandas as pd
    words, lens = split_words(texts)
    first = np.concatenate(([0], np.cumsum(lens)))[:-1]
    if not words:
        return np.empty((4, 0), dtype=np.int64), first, lens
    arr = np.empty(len(words), dtype=object)
    arr[:] = words
    code, distinct = pd.factorize(arr)
    word = hash_words(distinct)[code]
    form = hash_words([form_of(w) for w in distinct])[code]
    opens = np.zeros(len(words), dtype=bool)
    opens[first[lens > 0]] = True
    same = np.concatenate(([False], code[1:] == code[:-1])) & ~opens
    before = np.where(opens, np.uint64(1), np.concatenate((word[:1], word[:-1])))
    form_before = np.where(opens, np.uint64(1), np.concatenate((form[:1], form[:-1])))
    odd = np.uint64(0x9E3779B97F4A7C15)
    kinds = [word, before * odd + word + np.uint64(1), form + np.uint64(2),
             (form_before * odd + form) * odd + same.astype(np.uint64) + np.uint64(3)]
    mask = np.uint64((1 << bits) - 1)
    return np.stack([(mix64(k) & mask).astype(np.int64) for k in kinds]), first, lens


class Ftrl:
    """Per-coordinate FTRL-proximal learner of a logistic regression; the last weight is the bias."""

    def __init__(self, size: int):
        import numpy as np
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, i):
        import numpy as np
        z, n = self.z[i], self.n[i]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, i, x, y: float) -> None:
        import numpy as np
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          bits: int = BITS, max_examples: int = MAX_EXAMPLES, epochs: int = EPOCHS):
    """Weights (float64 [2 ** bits + 1], the bias last) of the model of ``labels``."""
    import numpy as np
    known = (labels.select(quoted(key).alias("k"), quoted(label).cast("double").alias("y"))
             .where("k IS NOT NULL AND y IS NOT NULL").groupBy("k").agg(F.max("y").alias("y"))
             .withColumn("h", F.xxhash64("k", F.lit(17))).orderBy("h", "k").limit(max_examples))
    # at most max_examples rows of three numbers: the bound of this broadcast
    rows = (docs.select(quoted(key).alias("k"), quoted(text).alias("t")).join(F.broadcast(known), "k")
            .groupBy("h", "k", "y").agg(F.min("t").alias("t")))

    def sparse(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                f, _, lens = features([t or ""], bits)
                i, c = np.unique(f, return_counts=True)
                out.append((i.astype(np.int32).tobytes(), (SCALE * c / max(1, lens[0])).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.binary()),
                 pa.array([o[1] for o in out], pa.binary())], names=["h", "y", "i", "x"])

    def fit(batches):
        import pyarrow as pa
        model, examples = Ftrl((1 << bits) + 1), []
        for batch in batches:
            for y, i, x in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                examples.append((np.append(np.frombuffer(i, np.int32), 1 << bits),
                                 np.append(np.frombuffer(x, np.float32), np.float32(1)), y))
        for _ in range(epochs):
            for i, x, y in examples:
                model.learn(i, x.astype(np.float64), y)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights(slice(None)).tobytes()], pa.binary())], names=["w"])

    vectors = rows.select("h", "y", "t").mapInArrow(tidy(sparse), "h long, y double, i binary, x binary")
    found = vectors.repartition(1).sortWithinPartitions("h").mapInArrow(tidy(fit), "w binary").first()
    return np.frombuffer(found["w"], np.float64) if found else np.zeros((1 << bits) + 1)


def score(docs: DataFrame, weights, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted`` (1 if at least
    ``threshold``)."""
    keep = without(docs, OUTPUTS)
    docs = docs.select(*[quoted(c) for c in keep])
    bits = (len(weights) - 1).bit_length() - 1
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def dot(batches):
        import numpy as np
        import pyarrow as pa
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                f, first, lens = features(["" if t is None else t for t in
                                           batch.column(batch.schema.get_field_index(text)).to_pylist()], bits)
                total = np.zeros(len(lens))
                full = lens > 0
                if full.any():
                    total[full] = np.add.reduceat(weights[f].sum(axis=0), first[full]) * SCALE / lens[full]
                s = 1 / (1 + np.exp(-np.clip(total + weights[-1], -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                    names=schema.names)

    return docs.mapInArrow(tidy(dot), schema)
