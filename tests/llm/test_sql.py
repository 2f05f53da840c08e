"""Registered queries with a SQL form against that SQL, over the whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from flowtally.llm.queries import LLM_QUERIES, LLM_SQL


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, folder)
    names = sorted(df.columns)
    want = con.sql(LLM_SQL[name])
    assert sorted(want.columns) == names
    ours = sorted(str(tuple(r)) for r in df.select(*names).collect())
    theirs = sorted(map(str, want.project(", ".join(names)).fetchall()))
    assert ours == theirs


def test_all_are_registered():
    names = set(entry_module.queries())
    assert {*LLM_QUERIES, "pipeline"} <= names
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(entry_module.oracle_sql()) <= names
