from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.functions.nulls import (
    ascending,
    descending,
    half_even,
    is_one_of,
    lenient_row_sum,
    lenient_sum,
    matches,
    ratio,
    strict_if,
    strict_sum,
)


def values(df):
    return [tuple(r) for r in df.collect()]


def test_strict_and_lenient_sums(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 3.0)], "k string, x double")
    out = df.groupBy("k").agg(strict_sum("x"), lenient_sum("x")).orderBy("k")
    assert values(out) == [("a", None, 1.0), ("b", None, 0.0), ("c", 5.0, 5.0)]


def test_strict_sum_over_a_window(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("c", 2.0), ("c", 3.0)], "k string, x double")
    w = Window.partitionBy("k")
    out = df.select("k", strict_sum("x", w).alias("s")).distinct().orderBy("k")
    assert values(out) == [("a", None), ("c", 5.0)]


def test_lenient_row_sum(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 3.0)], "a double, b double")
    assert values(df.select(lenient_row_sum("a", "b"))) == [(1.0,), (0.0,), (5.0,)]


def test_pattern_test_is_false_for_null(spark):
    df = spark.createDataFrame([("Total x",), ("y",), (None,)], "s string")
    assert values(df.select(matches("s", "total", ignore_case=True))) == [(True,), (False,), (False,)]
    assert df.where(~matches("s", "Total")).count() == 2


def test_membership(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert values(df.select(is_one_of("s", ["a"]))) == [(True,), (False,), (False,)]
    assert values(df.select(is_one_of("s", ["a", None]))) == [(True,), (False,), (True,)]


def test_strict_if(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    out = df.select(strict_if(F.col("x") > 2, F.lit("yes"), F.lit("no")))
    assert values(out) == [("no",), ("yes",), (None,)]


def test_missing_values_sort_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert values(df.orderBy(ascending("x"))) == [(1,), (2,), (None,)]
    assert values(df.orderBy(descending("x"))) == [(2,), (1,), (None,)]


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 8.0), (3.0, 8.0), (None, 2.0)], "a double, b double")
    assert values(df.select(ratio("a", "b"))) == [(None,), (0.125,), (0.375,), (None,)]
    assert values(df.select(half_even(ratio("a", "b"), 2))) == [(None,), (0.12,), (0.38,), (None,)]
