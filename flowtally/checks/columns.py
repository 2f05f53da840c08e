"""Projections and column algebra over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nulls import lenient_sum, strict_sum
from ..functions.text import operation_key
from ..operators import columns as K
from ..operators.ordered import number_rows
from ..operators.reshape import long_to_wide
from ..operators.totals import ordered_values, sum_numeric
from ..plans import cubes as Q
from ..session import staged
from ..sources import tables as T
from .registry import LINES, PRIORITIES, check, pivot_sql


@check("O11", sql="SELECT o_orderkey AS op_id, o_custkey AS client, o_orderstatus AS status FROM orders")
def rename_by_name(spark, folder):
    orders = T.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return K.rename(orders, {"o_orderkey": "op_id", "o_custkey": "client", "o_orderstatus": "status"})


@check("O12", sql="SELECT o_orderkey AS op_id, o_orderstatus AS status, o_totalprice AS price FROM orders")
def rename_by_position(spark, folder):
    orders = K.select_at(T.table(spark, folder, "orders"), -2, -5, -6)
    return K.rename_at(orders, {1: "op_id", 2: "status", 3: "price"})


@check("O12", sql="SELECT o_orderkey, o_totalprice FROM orders")
def select_by_position(spark, folder):
    return K.select_at(T.table(spark, folder, "orders"), 1, 4)


@check("O13", sql="SELECT p_partkey, p_name, p_size FROM part")
def keep_and_drop(spark, folder):
    return T.table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size").drop("p_brand")


@check("O14", "O17", sql="""SELECT l_orderkey, l_linenumber, sum(coalesce(l_quantity, 0)) AS l_quantity,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS l_extendedprice,
    CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS l_discount,
    CAST(sum(CAST(l_tax AS DECIMAL(12,2))) AS DOUBLE) AS l_tax FROM lineitem GROUP BY ALL""")
def map_column_range(spark, folder):
    """One change applied to every column from quantity to tax."""
    lines = T.table(spark, folder, "lineitem")
    names = K.column_range(lines, "l_quantity", "l_tax")
    exact = K.map_columns(lines, names, lambda c: c.cast("decimal(12,2)"))
    sums = exact.groupBy("l_orderkey", "l_linenumber").agg(*[F.sum(c).alias(c) for c in names])
    return K.map_columns(sums, names, lambda c: c.cast("double"))


@check("O15", sql="SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber FROM lineitem")
def columns_by_pattern(spark, folder):
    lines = T.table(spark, folder, "lineitem")
    return lines.select(*K.columns_like(lines, "key$|number$"))


@check("O16", "O55", sql="""SELECT s_nationkey, CAST(sum(s_suppkey) AS BIGINT) AS s_suppkey,
    CAST(sum(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS s_acctbal FROM supplier GROUP BY s_nationkey""")
def sum_numeric_columns(spark, folder):
    suppliers = T.table(spark, folder, "supplier").withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(12,2)"))
    sums = sum_numeric(suppliers, "s_nationkey")
    return sums.withColumn("s_acctbal", F.col("s_acctbal").cast("double"))


@check("O18", sql=f"WITH {LINES} SELECT year, {pivot_sql('op_type', 'n', PRIORITIES)} FROM lines GROUP BY year")
def columns_ordered_by_total(spark, folder):
    """Wide table whose columns stand in the order of their totals."""
    dated = T.movement_lines(spark, folder).withColumn("year", F.year("op_date"))
    long = staged(dated.groupBy("year", "op_type").agg(lenient_sum("n").alias("n")), "by-type")
    return long_to_wide(long, ["year"], "op_type", "n", ordered_values(long, "op_type", lenient_sum("n")), fill=0.0, unique=True)


@check("O19", sql="SELECT s_suppkey, s_acctbal, s_name, s_nationkey FROM supplier")
def move_column(spark, folder):
    return K.move_before(T.table(spark, folder, "supplier"), "s_acctbal", "s_name")


@check("O20", sql="SELECT s_suppkey, 2008 AS year, 'all EU member states' AS payee FROM supplier")
def constant_columns(spark, folder):
    return T.table(spark, folder, "supplier").select("s_suppkey", F.lit(2008).alias("year"), F.lit(Q.ALL_PAYEES).alias("payee"))


@check("O21", "O45", sql="""SELECT o_orderkey,
    CAST(year(o_orderdate) AS VARCHAR) || '_' || CAST(row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS VARCHAR)
      AS row_id FROM orders""")
def row_keys(spark, folder):
    """Delivery year and row number in the delivery, numbered in chunks."""
    orders = T.table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    numbered = number_rows(orders, "line", ["o_orderkey"], ["year"], chunks=20)
    return numbered.select("o_orderkey", F.concat_ws("_", "year", "line").alias("row_id"))


@check("O22", "O90", sql="""SELECT o_orderkey, 'RO-' || CAST(year(o_orderdate) AS VARCHAR) || '-' ||
    CASE WHEN o_orderkey % 7 = 0 THEN 'NA' WHEN o_orderkey < 100 THEN lpad(CAST(o_orderkey AS VARCHAR), 3, '0')
    ELSE CAST(o_orderkey AS VARCHAR) END AS op_id FROM orders""")
def operation_keys(spark, folder):
    """Composite ids; numbers longer than the padding stay whole, a missing one reads NA."""
    number = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey").cast("string"))
    return T.table(spark, folder, "orders").select("o_orderkey", operation_key(F.year("o_orderdate"), number).alias("op_id"))


@check("O23", sql="""SELECT l_orderkey, l_linenumber, sum(CASE WHEN l_linenumber <> 7 THEN l_quantity ELSE 0 END
    + CASE WHEN l_linenumber <> 3 THEN l_partkey ELSE 0 END + l_suppkey) AS total FROM lineitem GROUP BY ALL""")
def row_sum(spark, folder):
    """Sum across columns in which missing values count as 0."""
    lines = T.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("a"),
        F.when(F.col("l_linenumber") != 3, F.col("l_partkey").cast("double")).alias("b"),
        F.col("l_suppkey").cast("double").alias("c"),
    )
    return K.add_row_sum(lines, "total", ["a", "b", "c"]).groupBy("l_orderkey", "l_linenumber").agg(strict_sum("total").alias("total"))
