import datetime

from pyspark.sql import functions as F

from flowtally.operators.ordered import fill_down
from flowtally.session import new_folder, staged, staging_folder
from flowtally.sources import files as S


def write(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_carriage_returns_in_header_and_blank_fields(spark, tmp_path):
    path = write(tmp_path, "a.csv", '"",ID,"Escort\rLeaders"\r\n"",R1,2\r\n"",,3\r\n')
    rows = S.read_rows(spark, path, ["blank", "id", "n"]).orderBy(*S.ROW_ORDER).collect()
    assert [(r.blank, r.id, r.n) for r in rows] == [(None, "R1", "2"), (None, None, "3")]


def test_fields_beyond_the_header(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1,2\n1,2,3\n1\n")
    rows = S.read_rows(spark, path, ["a", "b"], overflow="more").orderBy(*S.ROW_ORDER).collect()
    assert [(r.a, r.b, r.more) for r in rows] == [("1", "2", None), ("1", "2", "3"), ("1", None, None)]


def test_lines_of_another_length_are_kept_whole(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1,2\n1,2,3,4\n1\n5,6\n")
    rows = S.read_rows(spark, path, ["a", "b"], quarantine="line").orderBy(*S.ROW_ORDER).collect()
    assert [(r.a, r.b, r.line) for r in rows] == [("1", "2", None), ("1", "2", "1,2,3,4"), ("1", None, "1"), ("5", "6", None)]
    rows = S.read_rows(spark, path, ["a", "b"], overflow="more", quarantine="line").orderBy(*S.ROW_ORDER).collect()
    assert [r.line for r in rows][1] == "1,2,3,4"


def test_line_feeds_inside_quotes(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'a,b\n"x\ny",5\n"z",6\n')
    rows = S.read_rows(spark, path, ["a", "b"], multi_line=True).orderBy(*S.ROW_ORDER).collect()
    assert [(r.a, r.b) for r in rows] == [("x\ny", "5"), ("z", "6")]


def test_row_order_survives_file_splits(spark, tmp_path):
    path = write(tmp_path, "big.csv", "n\n" + "".join(f"{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = staged(S.read_rows(spark, path, ["n"]))
        assert df.select("src_block").distinct().count() > 3
        order = [int(r.n) for r in df.orderBy("src_file", *S.ROW_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert order == list(range(5000))


def test_yearly_files_and_sheets(spark, tmp_path):
    paths = [write(tmp_path, f"yearly/t-{y} x.csv", f"n\n{y}\n") for y in (2019, 2020)]
    df = S.read_rows(spark, paths, ["n"]).withColumn("year", S.year_from_path())
    assert sorted((r.n, r.year) for r in df.collect()) == [("2019", 2019), ("2020", 2020)]
    for k in (12, 13, 14):
        write(tmp_path, f"book/sheet={k}/part.csv", f"n\n{k}\n")
    sheets = S.read_sheets(spark, str(tmp_path / "book"), ["n"], {2018: 12, 2017: 13})
    assert sorted((r.n, r.year) for r in sheets.collect()) == [("12", 2018), ("13", 2017)]
    assert "PartitionFilters: [sheet" in sheets._jdf.queryExecution().executedPlan().toString()


def test_sheets_of_several_workbooks_keep_their_row_order(spark, tmp_path):
    write(tmp_path, "a/sheet=2/part.csv", "id,n\nR1,1\n ,2\n,3\n")
    write(tmp_path, "b/sheet=5/part.csv", "id,n\n,4\nR2, 5\n")
    rows = staged(S.read_sheets(spark, [(str(tmp_path / "a"), 2, 2019), (str(tmp_path / "b"), 5, 2020)], ["id", "n"]))
    filled = fill_down(rows, ["id"], S.ROW_ORDER, ["src_file"]).orderBy("n").collect()
    assert [(r.id, r.n, r.year) for r in filled] == [("R1", "1", 2019), ("R1", "2", 2019), ("R1", "3", 2019), (None, "4", 2020), ("R2", "5", 2020)]


def test_typed_scan_and_quarantine(spark, tmp_path):
    path = write(tmp_path, "t.csv", "n,day\n1,2020-01-02\nx,2020-01-03\n")
    text = S.read_rows(spark, path, ["n", "day"])
    good = S.typed(text, {"n": "int", "day": "date"}).orderBy("day").collect()
    assert [(r.n, r.day) for r in good] == [(1, datetime.date(2020, 1, 2)), (None, datetime.date(2020, 1, 3))]
    assert [r.n for r in S.unfit_rows(text, {"n": "int", "day": "date"}).collect()] == ["x"]


def test_catalog_skips_published_tables(spark, tmp_path):
    for name in ("by_op.csv", "by_ms.csv", "cube_new.csv", "notes.txt"):
        write(tmp_path, f"c/{name}", "a,b\n1,2\n")
    loaded = S.load_catalog(spark, str(tmp_path / "c"))
    assert sorted(loaded) == ["by_ms", "by_op"]
    assert spark.table("by_op").columns == ["a", "b"]


def test_cubes_can_be_written_and_read(spark, tmp_path):
    cube = spark.createDataFrame([("a", 1.5)], "k string, v double")
    assert S.read_cube(spark, S.write_cube(cube, str(tmp_path / "p"))).collect() == cube.collect()
    assert S.read_typed(spark, S.write_cube(cube, str(tmp_path / "c"), "csv"), "k string, v double").collect() == cube.collect()


def test_tables_laid_out_by_year_are_pruned(spark, tmp_path):
    facts = spark.range(10).selectExpr("id", "int(2000 + id % 3) AS year")
    path = S.write_cube(facts, str(tmp_path / "facts"), by=["year"])
    one = S.read_cube(spark, path).where("year = 2001")
    assert sorted(r.id for r in one.collect()) == [1, 4, 7]
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_staging_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or staging_folder(spark) == named
    assert new_folder(spark, "x") != new_folder(spark, "x")
    df = staged(spark.range(3).withColumn("x", F.col("id") * 2))
    assert sorted(r.x for r in df.collect()) == [0, 2, 4]
