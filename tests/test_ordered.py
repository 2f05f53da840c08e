import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowtally.operators import ordered
from flowtally.operators.ordered import fill_down, number_rows, running_total
from flowtally.session import staged


def brute(rows, before=False):
    """(group, position, value) -> {(group, position): (filled, number, running sum)}"""
    out, state = {}, {}
    for g, p, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        last, n, total = state.get(g, (None, 0, None))
        last = v if v is not None else last
        n += 1
        total = total if v is None else (total or 0) + v
        state[g] = (last, n, total)
        out[g, p] = state[g]
    return out


def run(spark, rows, chunks, by=("g",)):
    df = spark.createDataFrame(rows, "g string, p long, v long").repartition(3)
    # both scans over one column, in one pass
    scans = {"last": ("v", ordered.LAST_VALUE), "t": ("v", ordered.TOTAL)}
    out = ordered.scan_rows(number_rows(df, "n", ["p"], by, chunks), scans, ["p"], by, chunks).collect()
    return {(r.g, r.p): (r.last, r.n, r.t) for r in out}


def test_fill_down_example(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, "A", None, None, "B", None])], "p long, v string")
    for chunks in (1, 2, 4, 30):
        out = [r.v for r in fill_down(df, ["v"], ["p"], chunks=chunks).orderBy("p").collect()]
        assert out == [None, "A", "A", "A", "B", "B"]


def test_two_scans_over_one_column(spark):
    df = spark.createDataFrame(list(enumerate([1, None, None, 2, None, None, 3, None])), "p long, v long")
    scans = {"last": ("v", ordered.LAST_VALUE), "sum": ("v", ordered.TOTAL)}
    for chunks in (1, 4, 8):
        out = ordered.scan_rows(df, scans, ["p"], chunks=chunks).orderBy("p").collect()
        assert [r.last for r in out] == [1, 1, 1, 2, 2, 2, 3, 3]
        assert [r.sum for r in out] == [1, 1, 1, 3, 3, 3, 6, 6]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=40),
    st.sampled_from([1, 3, 7, 50]),
)
def test_scans_match_brute_force(spark, cells, chunks):
    rows = [(g, i * 3, v) for i, (g, v) in enumerate(cells)]
    assert run(spark, rows, chunks) == brute(rows)


def test_one_group_with_a_third_of_all_rows(spark):
    r = random.Random(5)
    rows = [(("hot" if r.random() < 0.34 else f"g{r.randrange(40)}"), i, r.choice([None, None, i])) for i in range(3000)]
    assert run(spark, rows, chunks=30) == brute(rows)


def test_one_far_position_does_not_fill_a_chunk(spark, monkeypatch):
    rows = [("g", i, i if i % 5 == 0 else None) for i in range(999)] + [("g", 10**15, None)]
    assert run(spark, rows, chunks=10) == brute(rows)
    written = []
    monkeypatch.setattr(ordered, "staged", lambda df, label: written.append(staged(df, label)) or written[-1])
    number_rows(spark.createDataFrame(rows, "g string, p long, v long"), "n", ["p"], ["g"], 10).count()
    assert max(r["count"] for r in written[0].groupBy("__chunk").count().collect()) < 250


def test_sums_of_doubles_do_not_depend_on_chunks(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(i, r.random() * 10 ** r.randrange(6)) for i in range(1000)], "p long, v double")
    found = [[x.t for x in running_total(df, {"t": "v"}, ["p"], chunks=c).orderBy("p").collect()] for c in (1, 7, 40)]
    assert found[0] == found[1] == found[2]


def test_rows_above_only(spark):
    df = spark.createDataFrame([("a", i, 1.5) for i in range(10)], "g string, p long, v double")
    for chunks in (1, 3):
        out = running_total(df, {"t": "v"}, ["p"], ["g"], before=True, chunks=chunks).orderBy("p")
        assert [r.t for r in out.collect()] == [1.5 * i for i in range(10)]


def test_order_of_file_parts_comes_first(spark):
    # positions of the second part lie below those of the first
    rows = [("f", 0, 100 + i, "A" if i == 0 else None) for i in range(5)] + [("f", 50, i, "B" if i == 3 else None) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, part long, p long, v string")
    for chunks in (1, 2, 3):
        out = fill_down(df, ["v"], ["part", "p"], ["g"], chunks).orderBy("part", "p")
        assert [r.v for r in out.collect()] == ["A"] * 8 + ["B"] * 2


def test_columns_keep_their_order(spark):
    df = spark.createDataFrame([(1, "x", "a")], "p long, v string, g string")
    assert fill_down(df, ["v"], ["p"], ["g"]).columns == ["p", "v", "g"]
    assert number_rows(df, "n", ["p"]).columns == ["p", "v", "g", "n"]


@pytest.mark.parametrize("by", [(), ("g",)])
def test_row_numbers_start_at_one(spark, by):
    df = spark.range(10).select(F.col("id").alias("p"), F.lit("x").alias("g"), F.col("id").alias("v"))
    assert [r.n for r in number_rows(df, "n", ["p"], by).orderBy("p").collect()] == list(range(1, 11))


def test_chunks_are_found_by_compiled_columns(spark, monkeypatch):
    """No lambda per row; each row's chunk is the number of edges at or below it, NULL being lowest."""
    from bisect import bisect_right

    from flowtally.operators import ordered

    plans = []
    monkeypatch.setattr(ordered, "staged", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    edges = [("a", 3), ("a", 7), ("b", 1), ("b", 9), ("c", 2)]
    monkeypatch.setattr(ordered, "_edges", lambda *a: edges)
    data = [(g, i) for g in (None, "a", "b", "c") for i in (None, *range(12))]
    found = ordered.chunked(spark.createDataFrame(data, "g string, i int"), ["g", "i"], chunks=6).collect()
    low = lambda g, i: (g or "", -1 if i is None else i)
    assert len(found) == len(data) and all(r["__chunk"] == bisect_right(edges, low(r.g, r.i)) for r in found)
    assert "lambda" not in plans[0]
