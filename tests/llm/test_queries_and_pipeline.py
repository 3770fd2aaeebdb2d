"""Every query with SQL against DuckDB, the entry's guard, and the pipeline stage by stage."""

import os
import subprocess
import sys
import textwrap

import pytest

import corpus_pipeline
from textprice.llm.queries import ORACLES, QUERIES

from ..conftest import SF_SMALL
from ..oracle_check import compare, duck
from .test_models_and_layout import check_packing
from .test_text_operators import brute_classes


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(ORACLES[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None


def test_thirteen_queries_and_a_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert corpus_pipeline.QUERIES == {"pipeline": corpus_pipeline.run}


def test_entry_works_without_the_corpus_modules():
    code = textwrap.dedent("""
        import sys
        sys.modules["textprice.llm"] = None
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("textprice.llm"):
                    raise ModuleNotFoundError(name, name=name)
        del sys.modules["textprice.llm"]
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert len(e.queries()) > 80 and not any(n.startswith("op") and n[2].isdigit() for n in e.queries())
        assert "pipeline" not in e.queries() and e.oracle_sql()
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {}
    for n, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, SF_SMALL)
        if n < 4:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        kept[name] = {r["doc_id"]: r for r in docs.collect()} if n < 4 else docs.collect()
    assert list(kept) == ["quality", "near_duplicate", "substrings", "mixing", "packing"]
    told = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert sum(told[i] == 1 and i not in kept["quality"] for i in told) <= 0.03 * len(told)
    ids = sorted(kept["quality"])
    classes = brute_classes([kept["quality"][i]["text"] for i in ids])
    assert sorted(kept["near_duplicate"]) == sorted({ids[c] for c in classes})
    texts = {i: r["text"].split() for i, r in kept["near_duplicate"].items()}
    seen = {}
    for i, ws in texts.items():
        for k in range(len(ws) - 34):
            seen.setdefault(tuple(ws[k:k + 35]), []).append((i, k))
    gone = {(i, k + j) for places in seen.values() if len(places) > 1 for i, k in places for j in range(35)}
    assert gone and set(kept["substrings"]) == set(texts)
    for i, ws in texts.items():
        r = kept["substrings"][i]
        assert r["text"].split() == [w for k, w in enumerate(ws) if (i, k) not in gone] and r["n_chars"] == len(r["text"])
    assert set(kept["mixing"]) < set(kept["substrings"])
    words = {n: sum(len(r["text"].split()) for r in kept[n].values()) for n in ("substrings", "mixing")}
    assert 0.8 < words["mixing"] / words["substrings"] < 1  # 0.9 expected
    order = sorted(kept["mixing"])
    rows = [r.asDict() | {"doc_id": order.index(r["doc_id"])} for r in kept["packing"]]
    check_packing(rows, [kept["mixing"][i]["text"] for i in order], 4096)


def test_pipeline_of_empty_and_null_documents(spark, tmp_path):
    for sub, condition in (("none", "false"), ("blank", "doc_id < 5")):
        for t in ("documents", "labels"):
            df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet").where(condition)
            if t == "documents":
                df = df.selectExpr("doc_id", "cast(null as string) text", "lang", "cast(null as string) source", "n_chars")
            df.write.parquet(f"{tmp_path}/{sub}/{t}.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{sub}").count() in (0, 1, 2, 3, 4, 5)


FREED = """
import numpy as np
from textprice.llm.common import tidy

def anonymous():
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Anonymous")) / 1024

def task(batches):
    for n in batches:
        parts = [np.ones(12000) for _ in range(n)]  # 96 KB each, under the size that is mapped on its own
        kept.append(np.ones(12000))
        yield len(parts)

kept = []
before = anonymous()
assert list(tidy(task)([2000])) == [2000]
assert anonymous() - before < 60, (before, anonymous())
"""


def test_a_task_leaves_no_freed_memory_in_its_worker():
    """A worker held the 190 MB that a stage had freed through all later stages of the pipeline."""
    subprocess.run([sys.executable, "-c", FREED], check=True, cwd=os.path.dirname(corpus_pipeline.__file__))
    plain = FREED.replace("tidy(task)", "task")
    assert subprocess.run([sys.executable, "-c", plain], check=False, capture_output=True, cwd=os.path.dirname(corpus_pipeline.__file__)).returncode
