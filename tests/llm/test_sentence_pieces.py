"""Pieces by the agenda against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from textprice.llm.queries_text import PIECES
from textprice.llm.sentence_pieces import PieceEncoder, decode_pieces, encode_pieces, model_path

ODD = ["", " ", "   ", "a", " a", "a ", "  a   b  ", "tab\tand\nline\r\n", "▁ mark▁▁x", "naïve café 北京 😀 \U00010ffff",
       "x" * 5000, " " * 3000, "ab " * 20000, "\x00\x01 <s> </s> <unk> <0x41>", "1234567890 3.14", "é" * 700, "� ​  "]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=model_path(PIECES))


def test_agenda_equals_the_library(library):
    encoder = PieceEncoder(PIECES)
    assert encoder.by_segment
    rng = random.Random(3)
    alphabet = "aäbcdeeéimnorstuv   \n.,▁京😀"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]
    flat, lens = encoder.encode(texts)
    at = 0
    for t, n in zip(texts, lens, strict=True):
        assert flat[at:at + n].tolist() == library.encode(t), t[:60]
        at += n
    assert at == len(flat)


def test_whole_texts_without_segments_and_small_caches(library):
    whole, small = PieceEncoder(PIECES), PieceEncoder(PIECES, kept_bytes=64)
    whole.by_segment = False
    texts = [t for t in ODD if len(t) < 4000]
    for encoder in (whole, small, small):
        if encoder is whole:
            encoder.checked = lambda segments: [encoder.agenda(s.decode().replace(" ", "▁")) for s in segments]
        flat, _ = encoder.encode(texts)
        assert flat.tolist() == [i for t in texts for i in library.encode(t)]


def test_operator_on_special_rows(spark, library):
    rows = [(i, t, "n") for i, t in enumerate(ODD)] + [(None, "same text", None), (None, "same text", None), (99, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string").repartition(3)
    out = encode_pieces(df, PIECES, check="texts")
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        t = "same text" if r["doc_id"] is None else (ODD + [""] * 99)[r["doc_id"]]
        ids = library.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids)
    back = decode_pieces(out.withColumn("decoded", F.lit(1)), PIECES).select("decoded").collect()
    assert sorted(r[0] for r in back) == sorted(r["decoded"] for r in got)
    assert encode_pieces(df.limit(0), PIECES).count() == 0
    assert encode_pieces(df, PIECES).schema["ids"].dataType == T.BinaryType()


def test_wrong_check(spark):
    with pytest.raises(ValueError):
        encode_pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PIECES, check="none")


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = entry.queries()["op11_sentence_pieces"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
