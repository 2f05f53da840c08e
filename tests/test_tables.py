"""Columns, joins, shapes and totals."""

import re

import pytest
from pyspark.sql import functions as F

from flowtally import session
from flowtally.functions.nulls import lenient_sum, strict_sum
from flowtally.operators import columns as K
from flowtally.operators import joins as J
from flowtally.operators import reshape as S
from flowtally.operators import totals as A
from flowtally.plans import costs as C
from flowtally.sources import tables as T


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_column_operators(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0)], "a int, `b (1)` double, c string, `b (2)` double")
    assert K.rename(df, {"a": "z"}).columns == ["z", "b (1)", "c", "b (2)"]
    assert K.rename_at(df, {2: "b"}).columns == ["a", "b", "c", "b (2)"]
    assert K.select_at(df, 4, 1).columns == ["b (2)", "a"]
    assert K.select_at(df, -1, -3).columns == ["b (1)", "b (2)"]
    assert K.column_range(df, "b (1)", "b (2)") == ["b (1)", "c", "b (2)"]
    assert K.columns_like(df, r"^b \(") == ["b (1)", "b (2)"]
    assert K.numeric_columns(df) == ["a", "b (1)", "b (2)"]
    assert K.move_before(df, "c", "a").columns == ["c", "a", "b (1)", "b (2)"]
    assert K.add_row_sum(df, "s", ["b (1)", "b (2)"]).first()["s"] == 5.0
    with pytest.raises(ValueError):
        K.rename(df, {"nope": "z"})


def test_missing_keys_meet(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    b = spark.createDataFrame([(1, "c"), (None, "d"), (2, "e")], "k int, y string")
    assert J.join_on(a, b, "k").where(F.col("y").isNotNull()).count() == 2
    assert J.join_on(a, b, "k", null_safe=False).where(F.col("y").isNotNull()).count() == 1
    assert rows(J.join_on(a, b, "k", "full"), "y") == [(1, "a", "c"), (None, "b", "d"), (2, None, "e")]
    plan = J.join_on(a, b, "k", "full")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_joins_fan_out_and_refuse_clashes(spark):
    a = spark.createDataFrame([(1, "a")], "k int, x string")
    b = spark.createDataFrame([(1, "c"), (1, "d")], "k int, y string")
    assert J.join_on(a, b, "k").count() == 2
    with pytest.raises(ValueError):
        J.join_on(a, b.withColumnRenamed("y", "x"), "k")
    with pytest.raises(ValueError):
        J.join_shared(a, b.toDF("q", "r"))


def test_membership_joins(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    some = spark.createDataFrame([("a",), (None,)], "t string")
    assert J.keep_members(df, s=some).count() == 2
    assert rows(J.drop_members(df, "s", some)) == [("b",)]
    assert J.all_known(df.where("s is not null"), "s", ["a", "b"]) and not J.all_known(df, "s", ["a", "b"])


def test_duplicate_cells_are_an_error(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 2)], "k int, c string, v int")
    with pytest.raises(Exception, match="more than one row"):
        S.long_to_wide(df, ["k"], "c", "v", ["x"]).collect()


def test_wide_and_back(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "y", 5)], "k int, c string, v int")
    wide = S.long_to_wide(df, ["k"], "c", "v", ["x", "y"])
    assert rows(wide) == [(1, 1, None), (2, None, 5)]
    assert len(rows(S.wide_to_long(wide, ["k"], ["x", "y"], "c", "v"))) == 4
    assert rows(S.long_to_wide(df, ["k"], "c", "v", ["x", "y"], fill=0)) == [(1, 1, 0), (2, 0, 5)]


def test_values_without_a_column(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "z", 9), (2, None, 3), (3, "y", 4)], "k int, c string, v int")
    for values in (["x", "y"], ["x", "y", "z"]):
        with pytest.raises(Exception, match="column"):
            S.long_to_wide(df, ["k"], "c", "v", values).collect()
    out = S.long_to_wide(df, ["k"], "c", "v", ["x", "y"], fill=0, other="rest")
    assert out.columns == ["k", "x", "y", "rest"] and rows(out) == [(1, 1, 0, 9), (2, 0, 0, 3), (3, 0, 4, 0)]


def test_densify_and_diagonal(spark):
    df = spark.createDataFrame([("a", 2001, 5)], "k string, y int, v int")
    assert rows(S.densify(df, ["k"], "y", [2000, 2001], "v")) == [("a", 2000, 0), ("a", 2001, 5)]
    own = S.diagonal(df, "k", "v", ["a", "b"])
    assert own.columns == ["k", "y", "a", "b"] and rows(own) == [("a", 2001, 5, 0)]


def test_slots(spark):
    df = spark.createDataFrame([("r", "d1", None, None, 3.0, None, None)], "id string, a string, b string, c string, x double, y double, z double")
    out = S.slots_to_rows(df, ["id"], {"dest": ["a", "b", "c"], "n": ["x", "y", "z"]})
    assert rows(out) == [("r", 1, "d1", 3.0)]
    two = spark.createDataFrame([("r", "d1", "d2", None, 3.0, None, None)], df.schema)
    assert len(rows(S.slots_to_rows(two, ["id"], {"dest": ["a", "b", "c"], "n": ["x", "y", "z"]}))) == 2
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_totals(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", None, 4)], "k string, d string, n int")
    sub = A.with_subtotal(df, ["k", "d"], "d", "all", ["n"])
    assert sorted(map(str, rows(sub))) == sorted(map(str, [("a", "x", 1), ("a", "y", 2), ("b", None, 4), ("a", "all", 3), ("b", "all", 4)]))
    assert rows(A.with_grand_total(df.drop("d"), "k", "average")) == [("a", 3), ("average", 7), ("b", 4)]
    assert rows(A.single_rows(df.select("k", "n"), ["k"])) == [("b", 4)]
    assert A.ordered_values(df, "k", lenient_sum("n")) == ["b", "a"]
    assert rows(A.ranked_values(df.select("k"), "k", ["b"], "r"), "k") == [("a", None), ("a", None), ("b", 1)]


def test_top_by_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 5)], "k string, n int")
    assert [r.k for r in A.top_by(df, "k", strict_sum("n"), 3).collect()] == ["d", "a", "b"]


def test_movements_keep_all_partitions_by_operation(spark, tmp_path):
    """Tasks behind the shuffle by operation are as many as set, so their memory follows rows / partitions."""
    made = {
        "nation": ([(0, "NATION_0"), (1, "NATION_1")], "n_nationkey long, n_name string"),
        "supplier": ([(1, 0), (2, 1)], "s_suppkey long, s_nationkey long"),
        "orders": ([(i, 1, "1-URGENT") for i in range(200)], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "lineitem": ([(i % 200, 1 + i % 2, 1.0) for i in range(400)], "l_orderkey long, l_suppkey long, l_quantity double"),
    }
    for name, (data, schema) in made.items():
        df = spark.createDataFrame(data, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.lit("1995-01-01").cast("timestamp"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    moves = T.movements(spark, str(tmp_path), origin=False)
    assert moves.agg(F.sum("n")).first()[0] == 400
    assert moves.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_partitions_by_operation_follow_the_number_of_lines(spark, tmp_path, monkeypatch):
    """With few shuffle partitions set, a task would hold more rows the larger the table is."""
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 20)
    rows = {
        "nation": "SELECT 0L AS n_nationkey, 'A' AS n_name",
        "supplier": "SELECT 1L AS s_suppkey, 0L AS s_nationkey",
        "orders": "SELECT id AS o_orderkey, 1L AS o_custkey, '1-URGENT' AS o_orderpriority, timestamp'1995-01-01' AS o_orderdate FROM range(200)",
        "lineitem": "SELECT id % 200 AS l_orderkey, 1L AS l_suppkey, 1.0D AS l_quantity, 2.0D AS l_extendedprice, 0.0D AS l_discount FROM range(400)",
    }
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    for made, column in ((T.movements(spark, str(tmp_path), origin=False), "n"), (T.ledger(spark, str(tmp_path)), "amount")):
        assert int(made.agg(F.sum(column)).first()[0]) == (400 if column == "n" else 800)
        assert made.rdd.getNumPartitions() == 20 > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_lines_are_dealt_before_they_are_summed(spark, tmp_path, monkeypatch):
    """Sums in a scan, or in the few partitions set, would hold more lines in a task the larger the table is."""
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 20)
    rows = {
        "nation": "SELECT id AS n_nationkey, 'A' AS n_name FROM range(2)",
        "supplier": "SELECT id AS s_suppkey, id AS s_nationkey FROM range(2)",
        "orders": "SELECT id AS o_orderkey, 1L AS o_custkey, '1-URGENT' AS o_orderpriority, timestamp'1995-01-01' AS o_orderdate FROM range(200)",
        "lineitem": "SELECT id % 100 AS l_orderkey, id % 2 AS l_suppkey, 1.0D AS l_quantity, 2.0D AS l_extendedprice, 0.0D AS l_discount FROM range(400)",
    }
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    for made in (T.movements(spark, str(tmp_path), origin=False), T.ledger(spark, str(tmp_path))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        dealt = re.search(r"hashpartitioning\(op_id#\d+L, s_nationkey#\d+L, 20\), REPARTITION_BY_NUM", plan)
        assert dealt and "Aggregate" not in plan[dealt.end() :]
        assert made.count() == 100
    costs = C.operation_costs(T.movements(spark, str(tmp_path), origin=False), T.operation_payments(spark, str(tmp_path)), 1, null_safe=False)
    plan = costs._jdf.queryExecution().executedPlan().toString()
    dealt = [m.end() for m in re.finditer(r"hashpartitioning\(op_id#\d+L, [ls]_\w+#\d+L, 20\), REPARTITION_BY_NUM", plan)]
    assert len(dealt) == 2 and "Aggregate" not in plan[dealt[1] :]
    assert "ENSURE_REQUIREMENTS" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning(op_id" in x and ", 20)" not in x)
    assert [(r["n"], int(r["amount"])) for r in costs.collect()] == [(4.0, 8)] * 100
