"""Packing that keeps nothing in the Python workers."""

import os

from textprice.llm.packing import best_fit_packing, load_tokenizer


def test_small_slices_and_no_kept_encoder_give_the_same_rows(spark, tmp_path):
    import public_tokenizers
    file = str(tmp_path / "vocabulary.json")  # a name that no other test's worker holds
    os.symlink(public_tokenizers.path("word_bpe_49k.json"), file)
    rows = [(i, " ".join(f"word{i * j % 17} and" for j in range(i * 9 % 50))) for i in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    few = best_fit_packing(docs, file, capacity=64, slice_bytes=100, cached_words=5, keep_encoder=False)
    got = sorted(tuple(r) for r in few.select("doc_id", "piece", "start", "length", "ids_crc32").collect())

    def held(batches):
        import pyarrow as pa

        from textprice.llm.common import worker_state
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([file in worker_state()])], names=["held"])

    assert not any(r.held for r in spark.range(16).repartition(8).mapInArrow(held, "held boolean").collect())
    kept = best_fit_packing(docs, file, capacity=64)
    assert got == sorted(tuple(r) for r in kept.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert sum(r[3] for r in got) == sum(len(load_tokenizer(file).encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
