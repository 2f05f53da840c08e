"""Versions are whole, kept apart, typed, and checked against their manifest."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from flowtally.sources import snapshots as S


@pytest.fixture
def cubes(spark):
    numbers = spark.range(50, numPartitions=3).selectExpr("id", "CAST(id / 7 AS decimal(12,4)) AS part", "CAST(id AS double) / 3 AS third")
    names = spark.createDataFrame(
        [("a, \"b\"\nc", "2020-01-02", None), ("", "2021-12-31", 2), (None, None, 3), ("ä\\ö'", "2020-02-29", -1)],
        "name string, day string, n int",
    ).withColumn("day", F.to_date("day"))
    return {"numbers": numbers, "names": names}


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_read_back_typed(spark, tmp_path, cubes, form):
    out = str(tmp_path / "out")
    done = S.publish_tables(spark, out, cubes, form)
    assert done.version == 1 and done.tables["numbers"]["rows"] == 50
    for name, df in cubes.items():
        back = S.read_table(spark, out, name, checked=True)
        assert back.dtypes == df.dtypes and rows_of(back) == rows_of(df)
    listed = {r.cube: (r.n_rows, r.form, r.version) for r in S.catalog(spark, out).collect()}
    assert listed == {"numbers": (50, form, 1), "names": (4, form, 1)}


def test_second_run_replaces_the_first_for_readers(spark, tmp_path, cubes):
    out = str(tmp_path / "out")
    S.publish_tables(spark, out, cubes)
    open_reader = S.read_table(spark, out, "numbers")
    S.publish_tables(spark, out, {"numbers": cubes["numbers"].where("id < 5")})
    assert S.read_table(spark, out, "numbers").count() == 5
    assert open_reader.count() == 50 and S.read_table(spark, out, "numbers", version=1).count() == 50
    with pytest.raises(KeyError):
        S.read_table(spark, out, "names")


def test_a_broken_run_changes_nothing(spark, tmp_path, cubes):
    out = str(tmp_path / "out")
    S.publish_tables(spark, out, cubes)
    broken = cubes["numbers"].withColumn("third", F.when(F.col("id") > 30, F.raise_error(F.lit("lost"))).otherwise(F.col("third")))
    with pytest.raises(Exception, match="lost"):
        S.publish_tables(spark, out, {"names": cubes["names"].limit(1), "numbers": broken.withColumn("third", F.col("third").cast("double"))})
    assert S.versions(spark, out) == [1] and len(os.listdir(f"{out}/data")) == 1
    assert S.read_table(spark, out, "names", checked=True).count() == 4


def test_files_without_a_manifest_are_not_read(spark, tmp_path, cubes):
    """A run that stopped without any clean-up, and files of others inside a published folder."""
    out = str(tmp_path / "out")
    done = S.publish_tables(spark, out, cubes)
    cubes["numbers"].write.parquet(f"{out}/data/stopped/numbers")
    cubes["numbers"].limit(3).write.mode("append").parquet(f"{out}/{done.tables['numbers']['folder']}")
    assert S.read_table(spark, out, "numbers", checked=True).count() == 50
    assert S.expire(spark, out, keep=1) == [] and "stopped" in os.listdir(f"{out}/data")
    assert S.expire(spark, out, keep=1, unfinished_hours=0) == [] and "stopped" not in os.listdir(f"{out}/data")
    assert S.read_table(spark, out, "numbers").count() == 50


def test_changed_and_lost_files_are_found(spark, tmp_path, cubes):
    out = str(tmp_path / "out")
    entry = S.publish_tables(spark, out, cubes, "csv").tables["numbers"]
    first, second = (f"{out}/{entry['folder']}/{entry['files'][k]['file']}" for k in (0, 1))
    text = open(first).read()
    with open(first, "w") as file:
        file.write(text.replace("\n1,", "\n11,", 1))
    for path in (first, second):
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    os.remove(second)
    bad = {r["file"]: r.found_rows for r in S.damaged(spark, out, "numbers").collect()}
    assert bad == {entry["files"][0]["file"]: entry["files"][0]["rows"], entry["files"][1]["file"]: None}
    with pytest.raises(ValueError, match="manifest"):
        S.read_table(spark, out, "numbers", checked=True)


def test_two_runs_at_once_are_both_kept(spark, tmp_path, cubes, monkeypatch):
    out = str(tmp_path / "out")
    move, started, raced = S._move, [], []

    def race(*a):
        if not started:  # another run publishes just before this one switches
            started.append(True)
            raced.append(S.publish_tables(spark, out, {"numbers": cubes["numbers"].limit(1)}))
        return move(*a)

    monkeypatch.setattr(S, "_move", race)
    raced_by = S.publish_tables(spark, out, {"numbers": cubes["numbers"]})
    assert raced[0].version == 1 and raced_by.version == 2 and S.versions(spark, out) == [1, 2]
    assert S.read_table(spark, out, "numbers").count() == 50 and S.read_table(spark, out, "numbers", 1).count() == 1


def test_old_versions_go(spark, tmp_path, cubes):
    out = str(tmp_path / "out")
    for k in range(1, 5):
        S.publish_tables(spark, out, {"numbers": cubes["numbers"].limit(k)})
    assert S.expire(spark, out, keep=2) == [1, 2]
    assert S.versions(spark, out) == [3, 4] and len(os.listdir(f"{out}/data")) == 2
    assert S.read_table(spark, out, "numbers", 3).count() == 3
    with pytest.raises(FileNotFoundError):
        S.read_table(spark, out, "numbers", 1)
    with pytest.raises(ValueError):
        S.expire(spark, out, keep=0)


def test_folders_by_column_and_empty_tables(spark, tmp_path, cubes):
    out = str(tmp_path / "out")
    facts = cubes["numbers"].withColumn("year", F.col("id").cast("int") % 3 + 2000).select("year", "id")
    S.publish_tables(spark, out, {"facts": facts, "none": facts.where("id < 0")}, by={"facts": ["year"]})
    back = S.read_table(spark, out, "facts", checked=True)
    assert back.columns == ["id", "year"] and rows_of(back.select("year", "id")) == rows_of(facts)
    assert S.read_table(spark, out, "none", checked=True).columns == ["year", "id"] and S.read_table(spark, out, "none").count() == 0


def test_one_file_for_readers_of_files(spark, tmp_path, cubes):
    out, target = str(tmp_path / "out"), str(tmp_path / "web" / "numbers.csv")
    ordered = cubes["numbers"].repartition(5).orderBy(F.desc("id"))
    S.publish_tables(spark, out, {"numbers": ordered, "none": ordered.where("id < 0")}, "csv")
    for _ in range(2):  # the second one replaces the first
        S.export_file(spark, out, "numbers", target)
    with open(target, newline="") as file:
        rows = list(csv.reader(file))
    assert rows[0] == ["id", "part", "third"] and [int(r[0]) for r in rows[1:]] == list(range(49, -1, -1))
    S.export_file(spark, out, "none", str(tmp_path / "web" / "none.csv"))
    assert open(tmp_path / "web" / "none.csv").read() == "id,part,third\n"
    assert sorted(n for n in os.listdir(tmp_path / "web") if not n.startswith(".")) == ["none.csv", "numbers.csv"]
    with pytest.raises(ValueError, match="too many"):
        S.export_file(spark, out, "numbers", target, most_bytes=10)


@pytest.mark.parametrize("name", ["a/b", "", "_x", ".x", "a=b", "a:b"])
def test_names_become_folders(spark, tmp_path, cubes, name):
    with pytest.raises(ValueError, match="folders"):
        S.publish_tables(spark, str(tmp_path / "out"), {name: cubes["numbers"]})


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_table(spark, str(tmp_path / "none"), "numbers")
