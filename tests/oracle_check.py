"""Local twin of the driver's correctness gate: run every registered query on Spark and its
oracle SQL on DuckDB at one scale factor, compare row count, column names and sorted values.

    python tests/oracle_check.py [sf_dir] [name ...]

ORACLE_STRICT=1 compares floats bit for bit; PLAIN_SESSION=1 runs on a default session
(200 shuffle partitions, none of this library's session settings).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from textprice.session import build_session  # noqa: E402
from textprice.sources.tables import TABLES  # noqa: E402


STRICT = os.environ.get("ORACLE_STRICT") == "1"   # exact float equality (no rounding)


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {spark_cols} vs {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"rows differ: {len(spark_rows)} vs {len(duck_rows)}"
    order = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    dorder = sorted(range(len(duck_cols)), key=lambda i: duck_cols[i])
    a = sorted((tuple(norm(r[i]) for i in order) for r in spark_rows), key=key)
    b = sorted((tuple(norm(r[i]) for i in dorder) for r in duck_rows), key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first: {bad[0]}"
    return None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    if os.environ.get("PLAIN_SESSION") == "1":      # a default session, as a driver might use
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            failures += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(rows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            cur = con.execute(sqls[name])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            failures += 1
            continue
        msg = compare(rows, cols, drows, dcols)
        if msg:
            failures += 1
            print(f"FAIL {name}: {msg}")
        else:
            print(f"OK   {name}: {len(rows)} rows ({ts:.1f}s)")
    print(f"failures: {failures}")
    spark.stop()


if __name__ == "__main__":
    main()
