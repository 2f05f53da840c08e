"""The narrowest type that fits all values, in any order and partitioning."""

import datetime
import decimal

import pytest

from flowtally.sources import infer as I


def table(spark, *values, parts=2):
    return spark.createDataFrame([(v,) for v in values], "c string").repartition(parts)


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-20", " 3 ", ""], "bigint"),
        (["999999999999999999", "0"], "bigint"),
        (["9999999999999999999", "1"], "decimal(19,0)"),
        (["1", "2.50", "-1000.125"], "decimal(7,3)"),
        (["0.5", "12"], "decimal(3,1)"),
        (["0.123456789", "1"], "double"),
        (["1e5", "2"], "double"),
        (["Infinity", "-1.5", "NaN"], "double"),
        (["9" * 39, "1"], "double"),
        (["007", "008"], "string"),
        (["00.5"], "string"),
        (["1", "x"], "string"),
        (["12f"], "string"),
        (["true", "FALSE", None], "boolean"),
        (["2020-01-31", "1999-12-01"], "date"),
        (["2020-02-30"], "string"),
        (["31/01/2020", "01/02/2020"], "date"),
        (["01/31/2020", "02/01/2020"], "date"),
        (["31/01/2020", "01/31/2020"], "string"),
        (["1/2/2020", "12/11/2020"], "date"),
        (["20200131", "19991201"], "date"),
        (["20209931", "19991201"], "bigint"),
        (["2020-01-31", "31/01/2020"], "string"),
        ([None, "", "  "], "string"),
    ],
)
def test_types(spark, values, kind):
    assert I.infer_types(table(spark, *values))[0].type.simpleString() == kind


def test_values_and_notation(spark):
    df = spark.createDataFrame([("31/01/2020", "1.50", "a ", "7"), ("01/02/2020", "", None, "")], "d string, m string, t string, n string")
    out = I.with_inferred_types(df)
    assert [t for _, t in out.dtypes] == ["date", "decimal(3,2)", "string", "bigint"]
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == (datetime.date(2020, 1, 31), decimal.Decimal("1.50"), "a", 7)
    assert rows[1] == (datetime.date(2020, 2, 1), None, None, None)
    schema = [tuple(r) for r in I.inferred_schema(df).collect()]
    assert schema[0] == (0, "d", "date", "dd/MM/yyyy") and schema[3] == (3, "n", "bigint", None)


def test_partitions_do_not_matter(spark):
    values = [str(i / 4) for i in range(200)]
    kinds = {I.infer_types(table(spark, *values, parts=p))[0].type.simpleString() for p in (1, 3, 50)}
    assert kinds == {"decimal(4,2)"}


def test_only_some_columns_and_empty_tables(spark):
    df = spark.createDataFrame([("1", "2")], "`a b` string, c string")
    assert I.with_inferred_types(df, ["a b"]).dtypes == [("a b", "bigint"), ("c", "string")]
    assert I.infer_types(df, []) == []
    assert I.with_inferred_types(df.limit(0)).dtypes == df.dtypes
