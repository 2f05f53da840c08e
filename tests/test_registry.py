"""Every registered query against its SQL on the same tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from flowtally.checks import all_checks

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="session")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value) if isinstance(value, decimal.Decimal) else repr(value)


@pytest.mark.parametrize("name", sorted(all_checks()))
def test_query_equals_sql(spark, folder, duck, name):
    check = all_checks()[name]
    df = check.run(spark, folder)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert len(set(df.columns)) == len(df.columns)
    result = duck.execute(check.sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == theirs
    at = [names.index(c) for c in columns]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_every_operator_is_covered():
    covered = {c for check in all_checks().values() for c in check.covers}
    assert {f"O{i}" for i in range(1, 105)} | {f"A{i}" for i in range(1, 19)} <= covered


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["dest", "origin", "n"]
    assert set(all_checks()) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())
