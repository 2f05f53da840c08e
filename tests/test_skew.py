"""One order, one supplier and one customer with a third of the rows each."""

import pytest
from pyspark.sql import functions as F

from flowtally.checks import all_checks
from flowtally.sources import tables as T

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "3KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "3KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skewed(spark, folder, tmp_path):
    out = str(tmp_path)
    lines = T.table(spark, folder, "lineitem")
    lines = lines.withColumn("at", F.pmod(F.xxhash64(*lines.columns), F.lit(3))).withColumns(
        {
            "l_orderkey": F.when(F.col("at") == 0, F.lit(42)).otherwise(F.col("l_orderkey")).cast("long"),
            "l_suppkey": F.when(F.col("at") == 1, F.lit(5)).otherwise(F.col("l_suppkey")).cast("long"),
        }
    ).drop("at")
    lines.repartition(8).write.parquet(f"{out}/lineitem.parquet")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")).cast("long")
    T.table(spark, folder, "orders").withColumn("o_custkey", hot).repartition(8).write.parquet(f"{out}/orders.parquet")
    for name in ("customer", "supplier", "nation"):
        T.table(spark, folder, name).write.parquet(f"{out}/{name}.parquet")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield out
    for k in SETTINGS:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_skewed_joins_are_split_and_results_stay_whole(spark, skewed):
    matrix = all_checks()["route_matrix"].run(spark, skewed)
    plan = final_plan(matrix)
    assert "skew=true" in plan
    total = T.table(spark, skewed, "lineitem").agg(F.sum("l_quantity")).first()[0]
    assert matrix.agg(F.sum("n")).first()[0] == total


def test_a_hot_operation_enters_its_join_summed(spark, skewed):
    moves = T.movements(spark, skewed)
    assert moves.groupBy("op_id").count().agg(F.max("count")).first()[0] <= 25
    total = T.table(spark, skewed, "lineitem").agg(F.sum("l_quantity")).first()[0]
    assert moves.agg(F.sum("n")).first()[0] == total
