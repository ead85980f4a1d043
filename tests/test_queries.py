"""Every registered query runs at sf0.001 and equals its DuckDB oracle (exact values)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from cardlake.plans import QUERIES as REGISTERED, load_all  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402
from conftest import SF_SMOKE  # noqa: E402

load_all()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in REGISTERED}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMOKE)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows, False) == rows_of(dcols, drows, False)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_decks > 0
