"""Driver contract: entry smoke check and oracle parity of every query key."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import _rows
from tollgate.plans import catalog
from tollgate.plans.catalog import TABLES

from .conftest import SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"failed", "validation", "doc_id"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF01)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
