"""Every query with oracle SQL: Spark result == DuckDB result (rows, names, sorted values) at
sf0.001; rows-only queries: they run and return rows.  Queries of the corpus modules have their own
tests beside them."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

from textprice.plans.catalog import ORACLES, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    msg = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert msg is None, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 150
    assert df.columns == ["symbol", "dt", "n_posts", "text_chars", "text_fp"]
