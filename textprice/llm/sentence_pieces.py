"""Encoding texts with a merge-type (byte-pair) sentencepiece vocabulary, and decoding.

Method (agenda).  A text's characters are its first symbols.  Every two neighbours whose joined string is
in the vocabulary stand on an agenda ordered by score, then by place; the best is joined, its new
neighbours go on the agenda, entries whose symbols are gone are passed over, until none is left.
A symbol outside the vocabulary becomes its bytes' pieces.

Batches.  If no piece of the vocabulary has a space mark behind another character (checked when a model is
loaded; else the whole text is one segment), no join crosses the place before a run of spaces, so a text's
ids are those of its segments, each a run of spaces with what follows up to the next.  All segments of a
slice of a batch are cut out of one buffer, made distinct in Arrow and numbered; the agenda works on
distinct segments that the worker doesn't know yet, and texts are put together by one gather.  Known
segments are kept in two generations of about ``kept_bytes``: a full young one becomes the old one.

Check.  Ids of all new segments are compared with the sentencepiece library, a batch at a time; with
``check="texts"`` those of every whole text are, too.  A difference is an error.  ``decoded`` is the library's
``decode(ids)``.

Models with user-defined or unused pieces, a character map or another treatment of spaces than a first one
added and none removed are refused (ValueError).  Models are found on each executor by ``model``: a path, or
the name of a public vocabulary file.

Results for special inputs: null is the empty text, which has begin and end only and decodes to the empty
text; a text of spaces keeps them all; the mark U+2581 in a text is a space, as in the library; a very long text
is a slice of its own; repeated rows give equal rows; an empty table gives an empty result; an input column
with the name of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, without, worker_state
from .ragged import distinct, gather, slices, starts

MARK = "▁"
KEPT_BYTES = 80 << 20
ENTRY = 200  # bytes that a kept segment takes besides its own and its ids'
OUTPUTS = ("n_tokens", "ids", "decoded")
NORMAL, BYTE = 1, 6  # types of pieces


def model_path(model: str) -> str:
    import os
    if os.sep in model:
        return model
    import public_tokenizers
    return public_tokenizers.path(model)


class PieceEncoder:
    """Ids of texts by the agenda of a merge-type model."""

    def __init__(self, model: str, kept_bytes: int = KEPT_BYTES):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        self.library = SentencePieceProcessor(model_file=model_path(model))
        proto = sentencepiece_model_pb2.ModelProto.FromString(self.library.serialized_model_proto())
        rules, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if (proto.trainer_spec.model_type != 2 or rules.precompiled_charsmap or not rules.add_dummy_prefix
                or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
                or not proto.trainer_spec.byte_fallback or kinds & {4, 5}):
            raise ValueError(f"{model}: not a plain merge-type model with pieces for bytes")
        self.number = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = [p.score for p in proto.pieces]
        self.bytes_ids = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes_ids[int(p.piece[3:5], 16)] = i
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.by_segment = not any(MARK in p.lstrip(MARK) for p in self.number)
        self.kept_bytes, self.young, self.old, self.size = kept_bytes, {}, {}, 0

    def agenda(self, text: str) -> list[int]:
        """Ids of a normalised text, every space as the mark."""
        from heapq import heapify, heappop, heappush
        number, score = self.number, self.score
        symbols = list(text)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in number:
                waiting.append((-score[number[joined]], i, joined))
        heapify(waiting)
        while waiting:
            _, i, joined = heappop(waiting)
            j = right[i]
            # a joined symbol is the empty string at the place of its right half
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != len(joined):
                continue
            symbols[i], symbols[j] = joined, ""
            right[i] = j = right[j]
            if j < n:
                left[j] = i
                wider = joined + symbols[j]
                if wider in number:
                    heappush(waiting, (-score[number[wider]], i, wider))
            h = left[i]
            if h >= 0:
                wider = symbols[h] + joined
                if wider in number:
                    heappush(waiting, (-score[number[wider]], h, wider))
        ids = []
        for s in symbols:
            if s:
                known = number.get(s)
                if known is None:
                    ids.extend(self.bytes_ids[b] for b in s.encode())
                else:
                    ids.append(known)
        return ids

    def checked(self, segments: list[bytes]) -> list[list[int]]:
        """Ids of segments (each with the first space that the model adds), compared with the library's."""
        texts = [s.decode() for s in segments]
        own = [self.agenda(t.replace(" ", MARK)) for t in texts]
        told = self.library.encode([t[1:] for t in texts], num_threads=1)
        for t, a, b in zip(texts, own, told, strict=True):
            if len(t) == 1:  # a last space; by itself it would be the empty text
                b = self.library.encode("a ")[len(self.library.encode("a")):]
            if a != b:
                raise ValueError(f"the library encodes {t!r} otherwise: {b}, not {a}")
        return own

    def segment_ids(self, segments: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of distinct segments."""
        import numpy as np
        young, old = self.young, self.old
        found = [young.get(s) or old.get(s) for s in segments]
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            for i, ids in zip(new, self.checked([segments[i] for i in new]), strict=True):
                found[i] = np.array(ids, dtype="<u4").tobytes()
        for s, ids in zip(segments, found, strict=True):
            if s not in young:
                young[s] = ids
                self.size += len(s) + len(ids) + ENTRY
        if self.size > self.kept_bytes:
            self.young, self.old, self.size = {}, young, 0
        return found

    def encode(self, texts: list[str]):
        """(ids of all texts one after another, number of ids of each), without begin and end."""
        import numpy as np
        # the model's own first space stands before every text that is not empty
        spaced = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        data = b"".join(spaced)
        sizes = np.array([len(t) for t in spaced], dtype=np.int64)
        first = starts(sizes)
        if self.by_segment:
            space = np.frombuffer(data, dtype=np.uint8) == 32
            cut = space.copy()
            cut[1:] &= ~space[:-1]
            cut[first[sizes > 0]] = True
            at = np.flatnonzero(cut)
        else:
            at = first[sizes > 0]
        if not len(at):
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        rows, segments = distinct(data, np.append(at, len(data)))
        ids = self.segment_ids(segments)
        lens = np.array([len(x) >> 2 for x in ids], dtype=np.int64)
        flat = gather(np.frombuffer(b"".join(ids), dtype="<u4"), starts(lens), lens, rows)
        before = np.concatenate(([0], np.cumsum(lens[rows])))
        return flat, before[np.searchsorted(at, first + sizes)] - before[np.searchsorted(at, first)]


def piece_encoder(model: str, kept_bytes: int) -> PieceEncoder:
    """The encoder of this Python worker process: Spark uses a process for many tasks."""
    kept = worker_state()
    if ("pieces", model) not in kept:
        kept["pieces", model] = PieceEncoder(model, kept_bytes)
    return kept["pieces", model]


def encode_pieces(docs: DataFrame, model: str, text: str = "text", check: str = "segments",
                  kept_bytes: int = KEPT_BYTES) -> DataFrame:
    """``docs`` without the text, with n_tokens (begin and end counted), ids (binary: little-endian unsigned 32-bit)
    and decoded."""
    if check not in ("segments", "texts"):
        raise ValueError("check is segments or texts")
    keep = [c for c in without(docs, OUTPUTS) if c != text]
    docs = docs.select(*[quoted(c) for c in keep], F.coalesce(quoted(text), F.lit("")).alias(text))
    spec = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        encoder = piece_encoder(model, kept_bytes)
        begin, end = np.array([encoder.begin], dtype="<u4"), np.array([encoder.end], dtype="<u4")
        for batch in batches:
            place = batch.schema.get_field_index(text)
            for lo, hi in slices(pc.binary_length(batch.column(place)).to_pylist()):
                part = batch.slice(lo, hi - lo)
                texts = part.column(place).to_pylist()
                flat, lens = encoder.encode(texts)
                ids = [np.concatenate((begin, flat[i:i + n], end)) for i, n in zip(starts(lens), lens, strict=True)]
                listed = [x.tolist() for x in ids]
                if check == "texts" and listed != encoder.library.encode(texts, add_bos=True, add_eos=True, num_threads=1):
                    raise ValueError("the library encodes a text otherwise")
                decoded = encoder.library.decode(listed, num_threads=1)
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lens + 2, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
                     pa.array(decoded, pa.string())], names=spec.names)

    return docs.mapInArrow(encode, spec)


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``rows`` with decoded: the library's text of ``ids`` (binary, as ``encode_pieces`` gives them; null: none)."""
    keep = without(rows, ("decoded",))
    rows = rows.select(*[quoted(c) for c in keep])
    spec = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])

    def decode(batches):
        import numpy as np
        import pyarrow as pa
        library = piece_encoder(model, KEPT_BYTES).library
        for batch in batches:
            listed = [np.frombuffer(x or b"", dtype="<u4").tolist() for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(library.decode(listed, num_threads=1), pa.string())],
                                             names=spec.names)

    return rows.mapInArrow(decode, spec)
