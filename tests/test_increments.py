"""Cubes after increments equal those built from all rows at once."""

import os

import pytest
from pyspark.sql import functions as F

from flowtally.plans import increments as N
from flowtally.sources import snapshots as S

KEYS, MEASURES = ["year", "dest"], ["n", "amount"]
CUBES = {
    "by dest": lambda s: N.cube_of(s, ["dest"], strict={"n_strict": "n"}, lenient={"n": "n", "eur": "amount"}),
    "by year": lambda s: N.cube_of(s, ["year"], lenient={"n": "n"}),
}


def facts(spark, year, rows=200, gaps=7):
    df = spark.range(rows).withColumn("year", F.lit(year)).withColumn("dest", F.concat(F.lit("D"), F.col("id") % 9))
    df = df.withColumn("n", F.when(F.col("id") % gaps != 0, F.col("id") / 3))
    return df.select("year", "dest", "n", (F.col("id") * 1.1).cast("decimal(12,2)").alias("amount"))


def wanted(*tables):
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.union(t)
    strict = F.when(F.count("n") == F.count(F.lit(1)), F.sum("n"))
    dest = whole.groupBy("dest").agg(strict.alias("a"), F.sum("n").alias("b"), F.sum("amount").cast("double").alias("c"))
    return {
        "by dest": {r[0]: tuple(pytest.approx(x, rel=1e-9) if x is not None else None for x in r[1:]) for r in dest.collect()},
        "by year": {r[0]: (pytest.approx(r[1], rel=1e-9),) for r in whole.groupBy("year").agg(F.sum("n")).collect()},
    }


def found(spark, out):
    return {name: {r[0]: tuple(r)[1:] for r in S.read_table(spark, out, name, checked=True).collect()} for name in CUBES}


def test_deliveries_come_change_and_go(spark, tmp_path):
    out = str(tmp_path / "out")
    a, b, wrong, c = facts(spark, 2020), facts(spark, 2021, gaps=1000), facts(spark, 2021, rows=30), facts(spark, 2022, rows=5)
    N.add_delivery(spark, out, "2020", a, KEYS, MEASURES, CUBES)
    N.add_delivery(spark, out, "2021", wrong, KEYS, MEASURES, CUBES)
    assert found(spark, out) == wanted(a, wrong)
    done = N.add_delivery(spark, out, "2021", b, KEYS, MEASURES, CUBES)
    assert found(spark, out) == wanted(a, b) and N.deliveries(spark, out) == ["2020", "2021"]
    assert done.tables["state of 2020"] == S.manifest(spark, out, 1).tables["state of 2020"]  # not written again
    N.add_delivery(spark, out, "2022", c, KEYS, MEASURES, CUBES)
    assert found(spark, out) == wanted(a, b, c)
    N.remove_delivery(spark, out, "2020", CUBES)
    assert found(spark, out) == wanted(b, c) and N.deliveries(spark, out) == ["2021", "2022"]
    with pytest.raises(KeyError):
        N.remove_delivery(spark, out, "2020", CUBES)


def test_files_that_a_later_version_lists_outlive_their_own(spark, tmp_path):
    out = str(tmp_path / "out")
    a, b = facts(spark, 2020), facts(spark, 2021)
    N.add_delivery(spark, out, "a", a, KEYS, MEASURES, CUBES)
    N.add_delivery(spark, out, "b", b.limit(3), KEYS, MEASURES, CUBES)
    N.add_delivery(spark, out, "b", b, KEYS, MEASURES, CUBES)
    assert S.expire(spark, out, keep=1) == [1, 2] and len(os.listdir(f"{out}/data")) == 2
    N.add_delivery(spark, out, "c", facts(spark, 2022), KEYS, MEASURES, CUBES)
    assert found(spark, out) == wanted(a, b, facts(spark, 2022))


def test_a_cube_without_deliveries_is_empty(spark, tmp_path):
    out = str(tmp_path / "out")
    N.add_delivery(spark, out, "a", facts(spark, 2020), KEYS, MEASURES, CUBES)
    N.remove_delivery(spark, out, "a", CUBES)
    assert found(spark, out) == {"by dest": {}, "by year": {}} and N.deliveries(spark, out) == []


def test_unknown_values_come_back_out(spark, tmp_path):
    """A missing value makes strict sums NULL only while its delivery is in."""
    out = str(tmp_path / "out")
    schema = "year int, dest string, n double, amount decimal(12,2)"
    good, bad = spark.createDataFrame([(1, "A", 0.1, None)], schema), spark.createDataFrame([(1, "A", None, None), (1, None, 2.0, None)], schema)
    cubes = {"cube": lambda s: N.cube_of(s, ["dest"], strict={"strict": "n"}, lenient={"lenient": "n"})}
    N.add_delivery(spark, out, "good", good, KEYS, MEASURES, cubes)
    N.add_delivery(spark, out, "bad", bad, KEYS, MEASURES, cubes)
    assert {tuple(r) for r in S.read_table(spark, out, "cube").collect()} == {("A", None, 0.1), (None, 2.0, 2.0)}
    N.remove_delivery(spark, out, "bad", cubes)
    assert [tuple(r) for r in S.read_table(spark, out, "cube").collect()] == [("A", 0.1, 0.1)]
