"""Corpus queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import _rows
from tollgate.llm.catalog import oracle_sql

from ..conftest import SF01


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, key):
    df = E.queries()[key](spark, SF01)
    res = duck.execute(E.oracle_sql()[key])
    cols, rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, rows)
