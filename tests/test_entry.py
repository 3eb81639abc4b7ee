"""The driver contract: entry(), queries() and their DuckDB oracles at sf0.001."""

from __future__ import annotations

import inspect
import re

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

ROWS_ONLY: set[str] = set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == E.REPORT_COLUMNS and len(rows) == 8


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) - set(E.core_oracles()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.core_queries()) - ROWS_ONLY))
def test_query_matches_oracle(spark, duck, name):
    df = E.core_queries()[name](spark, SF_SMALL)
    got_rows, got_cols = rows_of(df.columns, df.collect())
    rel = duck.sql(E.core_oracles()[name])
    want_rows, want_cols = rows_of(rel.columns, rel.fetchall())
    assert got_cols == want_cols
    assert got_rows == want_rows


def test_queries_read_whole_tables():
    """No row caps, samples or modulo subsets in the registered queries or their oracles."""
    for name, sql in E.core_oracles().items():
        assert not re.search(r"\bLIMIT\b|\bSAMPLE\b|%", sql, re.I), name
    source = inspect.getsource(E)
    assert not re.search(r"\.limit\(|\.sample\(|\.head\(|\.take\(|%\s*\d", source)
