"""Movements and ledger as views over a star schema of orders, lines and places.

An order is an operation, its customer's nation the origin, each line's supplier
nation a destination, the quantity the number of people and the net price the
money paid. Two grains are offered:

* by line, for cubes whose keys are few: the joins feed a partial aggregate, so
  only group sums are shuffled after them and a skewed join partition can be split
  at run time;
* by operation and destination, for everything that works per operation: lines are
  summed *before* they meet the orders, so a key with a large share of all lines
  enters that join with at most one row per place. The order join comes last and
  leaves the rows partitioned by operation for the aggregates that follow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import strict_sum
from ..functions.text import MONEY
from ..session import partitions_for


_schemas: dict[tuple[str, str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables; its schema is looked up once per session, not once per query."""
    path = f"{folder}/{name}.parquet"
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def amount() -> Column:
    """Net price of a line, exact to four decimals."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return (price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY)


def _places(spark: SparkSession, folder: str, key: str, name: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))


def operation_headers(spark: SparkSession, folder: str, origin: bool = True) -> DataFrame:
    """op_id, op_date, op_type, origin: one row per order. Without `origin`, no customer is looked up."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("op_id"),
        F.col("o_orderdate").cast("date").alias("op_date"),
        F.col("o_orderpriority").alias("op_type"),
        "o_custkey",
    )
    if not origin:
        return orders.drop("o_custkey")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        orders.join(customers, "o_custkey")
        .join(_places(spark, folder, "c_nationkey", "origin"), "c_nationkey")
        .select("op_id", "op_date", "op_type", "origin")
    )


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")


def movement_lines(spark: SparkSession, folder: str) -> DataFrame:
    """op_id, op_date, op_type, origin, dest, n: one row per line."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("op_id"), "l_suppkey", F.col("l_quantity").alias("n"))
    return (
        lines.join(_suppliers(spark, folder), "l_suppkey")
        .join(operation_headers(spark, folder), "op_id")
        .join(_places(spark, folder, "s_nationkey", "dest"), "s_nationkey")
        .select("op_id", "op_date", "op_type", "origin", "dest", "n")
    )


def keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """dest, origin, n per line, with nation keys in place of names."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", F.col("l_quantity").alias("n"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("origin"))
    return (
        lines.join(_suppliers(spark, folder), "l_suppkey")
        .join(orders.join(customers, "c_custkey"), "l_orderkey")
        .select(F.col("s_nationkey").alias("dest"), "origin", "n")
    )


def with_names(spark: SparkSession, folder: str, routes: DataFrame) -> DataFrame:
    """Nation names for the keys in dest and origin of an aggregated table."""
    for side in ("dest", "origin"):
        routes = routes.withColumnRenamed(side, "__key").join(_places(spark, folder, "__key", side), "__key").drop("__key")
    return routes.select("dest", "origin", *[c for c in routes.columns if c not in ("dest", "origin")])


def _summed(lines: DataFrame, place: str, total: Callable[[str], Column], out: str, partitions: int) -> DataFrame:
    """op_id, place and the total of a column, in partitions by operation.

    Lines are dealt by operation and place before they are summed: partial sums in a scan would hold
    nearly all lines of its split in memory, and so would the few partitions that a session sets. Of
    an operation with very many lines, those of each place are summed apart.
    """
    dealt = lines.repartition(partitions, "op_id", place)
    return dealt.groupBy("op_id", place).agg(total(out).alias(out)).repartition(partitions, "op_id")


def _by_destination(spark: SparkSession, folder: str, value: Column, total: Callable[[str], Column], out: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    lines = lineitem.select(F.col("l_orderkey").alias("op_id"), "l_suppkey", value.alias(out)).join(_suppliers(spark, folder), "l_suppkey")
    return _summed(lines.drop("l_suppkey"), "s_nationkey", total, out, partitions_for(lineitem))


def movements(spark: SparkSession, folder: str, origin: bool = True) -> DataFrame:
    """op_id, op_date, op_type, origin, dest, n: one row per operation and destination.

    A missing quantity makes its row's `n` NULL, so sums above keep their NULL rule.
    Analyses that never look at the origin leave it out and save the customer join.
    The shuffle by operation has partitions by the number of lines and keeps them all: sorts
    and aggregates per operation pile up behind it in one task, which run-time coalescing
    would fill by compressed size.
    """
    per_place = _by_destination(spark, folder, F.col("l_quantity"), strict_sum, "n")
    columns = ["op_id", "op_date", "op_type", *(["origin"] if origin else []), "dest", "n"]
    return (
        per_place.join(operation_headers(spark, folder, origin), "op_id")
        .join(_places(spark, folder, "s_nationkey", "dest"), "s_nationkey")
        .select(*columns)
    )


def _years(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("op_id"), F.year("o_orderdate").alias("year"))


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """op_id, year, payee, amount: one row per line, paid to the supplier's nation."""
    return (
        ledger_lines(spark, folder, "l_suppkey")
        .join(_suppliers(spark, folder), "l_suppkey")
        .join(_years(spark, folder), "op_id")
        .join(_places(spark, folder, "s_nationkey", "payee"), "s_nationkey")
        .select("op_id", "year", "payee", "amount")
    )


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """op_id, year, payee, amount: one row per operation and payee; shuffled by operation like `movements`."""
    per_place = _by_destination(spark, folder, amount(), F.sum, "amount")
    return (
        per_place.join(_years(spark, folder), "op_id")
        .join(_places(spark, folder, "s_nationkey", "payee"), "s_nationkey")
        .select("op_id", "year", "payee", "amount")
    )


def ledger_lines(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """op_id, amount per line, for uses that need no payee."""
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("op_id"), amount().alias("amount"), *more)


def operation_payments(spark: SparkSession, folder: str) -> DataFrame:
    """op_id, amount: sums of an operation's lines by supplier, for sums by operation; shuffled by it like `movements`."""
    partitions = partitions_for(table(spark, folder, "lineitem"))
    return _summed(ledger_lines(spark, folder, "l_suppkey"), "l_suppkey", F.sum, "amount", partitions).select("op_id", "amount")


def operation_types(spark: SparkSession, folder: str) -> DataFrame:
    """op_id, op_type as delivered apart from the movements."""
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("op_id"), F.col("o_orderpriority").alias("op_type"))


def countries(spark: SparkSession, folder: str) -> DataFrame:
    """name, iso: the nations as a country dimension."""
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso")
    )
