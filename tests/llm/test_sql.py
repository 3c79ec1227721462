"""The queries that SQL can express, against it."""

from __future__ import annotations

import duckdb
import pytest

from tallywing.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(tuple(r[c] for c in want.columns) for r in got.collect())
    assert rows == sorted(want.fetchall())
