"""Queries with SQL against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from carelake.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_equals_sql(spark, name):
    own = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels"):
        own.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    wanted = own.sql(SQL[name])
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(wanted.columns)
    got = sorted(map(repr, (tuple(r[c] for c in wanted.columns) for r in found.collect())))
    assert got == sorted(map(repr, wanted.fetchall()))
