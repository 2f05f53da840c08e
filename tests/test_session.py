import os
import time

import pytest

from flowtally import session
from flowtally.plans.publish import publish, published
from flowtally.sources.files import read_cube


class Remote:
    """A session whose master is no local one."""

    class sparkContext:
        master, applicationId = "spark://host:7077", "app"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_folder(Remote)


def test_publishing_leaves_only_its_cubes(spark, tmp_path):
    moves = spark.createDataFrame([(1, "2020-01-02", "A", "X", 12.0)], "op_id long, op_date string, origin string, dest string, n double")
    moves = moves.selectExpr("op_id", "to_date(op_date) AS op_date", "origin", "dest", "n")
    types = spark.createDataFrame([(1, "JRO")], "op_id long, op_type string")
    ledger = spark.createDataFrame([(1, 2020, "A", 5)], "op_id long, year int, payee string, amount int").selectExpr("op_id", "year", "payee", "CAST(amount AS decimal(18,4)) AS amount")
    countries = spark.createDataFrame([("A", "AAA"), ("X", "XXX")], "name string, iso string")
    base = session.staging_folder(spark)
    before = set(os.listdir(base.removeprefix("file:")))
    paths = publish(moves, types, ledger, countries, str(tmp_path / "out"))
    assert set(os.listdir(base.removeprefix("file:"))) == before
    for name, cube in published(moves, types, ledger, countries).items():
        assert sorted(map(str, read_cube(spark, paths[name]).collect())) == sorted(map(str, cube.collect())), name


def test_published_movements_are_shuffled_once_per_operation_cube(spark):
    moves = spark.createDataFrame([(1, "2020-01-02", "A", "X", 12.0)], "op_id long, op_date string, origin string, dest string, n double")
    moves = moves.selectExpr("op_id", "to_date(op_date) AS op_date", "origin", "dest", "n")
    types = spark.createDataFrame([(1, "JRO")], "op_id long, op_type string")
    ledger = spark.createDataFrame([(1, 2020, "A", 5)], "op_id long, year int, payee string, amount int").selectExpr("op_id", "year", "payee", "CAST(amount AS decimal(18,4)) AS amount")
    countries = spark.createDataFrame([("A", "AAA")], "name string, iso string")
    plan = published(moves, types, ledger, countries, null_safe=False)["averages_omitted"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(op_id") == 1 and "REPARTITION_BY_NUM" in plan


def test_published_movements_take_partitions_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 2)
    moves = spark.range(40).selectExpr("id AS op_id", "date'2020-01-02' AS op_date", "'A' AS origin", "'X' AS dest", "12.0D AS n")
    types = spark.createDataFrame([(1, "JRO")], "op_id long, op_type string")
    ledger = spark.range(40).selectExpr("id AS op_id", "2020 AS year", "'A' AS payee", "CAST(5 AS decimal(18,4)) AS amount")
    countries = spark.createDataFrame([("A", "AAA")], "name string, iso string")
    plan = published(moves, types, ledger, countries, null_safe=False)["averages_omitted"]._jdf.queryExecution().executedPlan().toString()
    assert ", 20), REPARTITION_BY_NUM" in plan


def test_released_copies_leave_no_shuffle_files(spark):
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    rows = spark.range(1000).repartition(4, "id")
    before = files()
    session.staged(rows, "kept")
    kept = files()
    assert kept - before
    copy = session.staged(rows.where("id > 9"), "released", release=True)
    for _ in range(50):
        if not files() - kept:
            break
        time.sleep(0.1)
    assert not files() - kept
    assert copy.count() == 990
    assert spark.conf.get(session.CLEANUP, None) is None
