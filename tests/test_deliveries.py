import datetime

import pytest
from pyspark.sql import functions as F

from flowtally.plans import deliveries as D
from flowtally.sources.files import read_rows

RETURNS = """RO-ID,Date of Departure type of operation,,MSSAC,Destination(s),Number of TCNs,
RO-00001,12/03/2019 JRO,,Austria,Kosovo*,,20
"",,,Greece,Afghanistan,,3
RO-00001 Total,,,,,,23
RO-ID,Date of Departure type of operation,,MSSAC,Destination(s),Number of TCNs,
RO-00002 13/03/2019 NRO,,,Italy,The Gambia,,5
RO-00002 Total,,,,,,6
RO-00003 ,14/03/2019 CRO,,Italy,Tunisia,,,12
RO-00003 Total,,,,,,12
"* a footnote, with a comma",,,,,,
RO-00004,15/03/2019 CRO,,France,Georgia,,7
RO-00004 Total,,,,,,7
"""

COUNTRIES = [("Austria", "AUT"), ("Italy", "ITA"), ("Slovak Republic", "SVK")]


def raw(spark, tmp_path, text, names, **options):
    path = tmp_path / "delivery.csv"
    path.write_text(text)
    return read_rows(spark, str(path), names, **options)


def test_continuation_rows(spark, tmp_path):
    rows = raw(spark, tmp_path, RETURNS, D.RETURN_COLUMNS, overflow="overflow")
    day = lambda d: datetime.date(2019, 3, d)
    assert [tuple(r) for r in D.tidy_returns(rows).orderBy("op_id", "origin").collect()] == [
        ("RO-00001", day(12), "JRO", "Austria", "Kosovo", 20.0),
        ("RO-00001", day(12), "JRO", "Greece", "Afghanistan", 3.0),
        ("RO-00002", day(13), "NRO", "Italy", "Gambia", 5.0),
        ("RO-00004", day(15), "CRO", "France", "Georgia", 7.0),
    ]


def test_shifted_rows_are_kept_apart(spark, tmp_path):
    rows = raw(spark, tmp_path, RETURNS, D.RETURN_COLUMNS, overflow="overflow")
    assert [(r.op_id, r.overflow) for r in D.shifted_returns(rows).collect()] == [("RO-00003", "12")]


def test_subtotals_are_compared(spark, tmp_path):
    rows = raw(spark, tmp_path, RETURNS, D.RETURN_COLUMNS, overflow="overflow")
    out = sorted(tuple(r) for r in D.subtotal_differences(rows).collect())
    assert out == [("RO-00002", 5.0, 6.0), ("RO-00003", None, 12.0)]


def test_staff_totals(spark, tmp_path):
    line = '"",RO-00001,12/03/2019,Austria,2,46,0,0,0,0,0,2,1,,1,0,4\r\n'
    text = ",".join(D.STAFF_COLUMNS) + "\r\n" + line + '"",RO-ID,RO Date,MSSAC,,,,,,,,,,,,,\r\n'
    (row,) = D.staff(raw(spark, tmp_path, text, D.STAFF_COLUMNS)).collect()
    assert (row.n_monitors, row.n_obs, row.n_esc_obs_med, row.n_obs_tc) == (5.0, 1.0, 51.0, None)


def test_costs_and_staff_side_by_side(spark, tmp_path):
    costs = 'RO-ID,Date,MS/SAC,TOTAL PAID\nRO-00001,12/03/2019,AUT,"€    4 9,883.90"\nRO-00002,13/03/2019,ITA,€    -\nRO-00003,14/03/2019,XXX,€ 1\n'
    paid = raw(spark, tmp_path, costs, D.COST_COLUMNS)
    staff = spark.createDataFrame(
        [(None, "RO-00001", "12/03/2019", "Austria", "1"), (None, "RO-00009", "14/03/2019", "Nowhere", "2")],
        "blank string, op_id string, op_date string, origin string, n_esc string",
    )
    for c in D.STAFF_COLUMNS[4:]:
        if c not in staff.columns:
            staff = staff.withColumn(c, F.lit(None).cast("string"))
    countries = spark.createDataFrame(COUNTRIES, "name string, iso string")
    out = D.staff_and_costs(paid, staff, countries)
    got = sorted((r.op_id, r.iso, r.origin, None if r.amount is None else float(r.amount), r.n_esc) for r in out.collect())
    assert got == [
        ("RO-00001", "AUT", "Austria", 49883.9, 1.0),
        ("RO-00002", "ITA", "Italy", None, None),
        ("RO-00003", "XXX", None, 1.0, None),
        ("RO-00009", None, "Nowhere", None, 2.0),
    ]


def test_representatives(spark, tmp_path):
    text = "RO-ID,RO Date,Count\nRO-00001,12/03/2019,1\nRO-ID,RO Date,Count\nRO-00002,13/03/2019,0\n"
    out = D.representatives(raw(spark, tmp_path, text, D.REPRESENTATIVE_COLUMNS)).orderBy("op_id")
    assert [(r.op_id, r.op_date.day, r.n_staff) for r in out.collect()] == [("RO-00001", 12, 1.0), ("RO-00002", 13, 0.0)]


def test_sheets(spark):
    slots = {c: "double" for g in ("n", "n_esc", "n_esc_lead") for c in D.SLOTS[g]} | {c: "string" for c in D.SLOTS["dest"]}
    schema = "year int, number string, op_date date, origin string, op_type string, n_esc_obs_med double, n_meds double, n_obs double, src_row long"
    base = spark.createDataFrame(
        [
            (2010, "1", None, "UK (observer)", "jro", 3.0, 1.0, None, 10),
            (2010, "1", datetime.date(2010, 5, 6), "Austria", "JRO", 9.0, None, None, 11),
            (2010, None, datetime.date(2010, 5, 7), "N/A", "cro", None, None, None, 12),
        ],
        schema,
    )
    for c, t in slots.items():
        base = base.withColumn(c, F.lit(None).cast(t))
    first = F.col("src_row") == 10
    base = base.withColumns(
        {
            "Destination (1)": F.when(first, F.lit("Republic of the Congo")),
            "Returnees (1)": F.when(first, F.lit(7.0)),
            "Escorts (1)": F.when(first, F.lit(4.0)),
            "Destination (2)": F.when(first, F.lit("x")),
            "Escort leaders (3)": F.when(F.col("src_row") == 11, F.lit(2.0)),
        }
    )
    countries = spark.createDataFrame([("Austria", "AUT"), ("United Kingdom", "GBR")], "name string, iso string")
    heads = D.sheet_headers(base, countries, ["src_row"])
    ops = {r.row_id: r for r in D.sheet_operations(heads).collect()}
    assert sorted(ops) == ["2010_1", "2010_2", "2010_3"]
    uk, at, none = ops["2010_1"], ops["2010_2"], ops["2010_3"]
    assert (uk.origin, uk.iso, uk.id, uk.op_type, str(uk.op_date)) == ("United Kingdom", "GBR", "2010_1", "JRO", "2010-12-31")
    assert (uk.n_esc_obs_med, at.n_esc_obs_med, none.n_esc_obs_med) == (5.0, 9.0, None)
    assert (none.id, none.origin, none.iso) == (None, None, None)
    dests = {(r.row_id, r.slot): r for r in D.sheet_destinations(heads).collect()}
    assert sorted(dests) == [("2010_1", 1), ("2010_2", 3)]
    assert (dests["2010_1", 1].dest, dests["2010_1", 1].staff_agrees) == ("Congo DR", True)
    assert (dests["2010_2", 3].dest, dests["2010_2", 3].staff_agrees) == (None, None)


@pytest.mark.parametrize(("make", "label"), [("_raw_returns", "moves"), ("_payments", "raw-ledger")])
def test_deliveries_read_the_lines_once(spark, folder, monkeypatch, make, label):
    from flowtally.checks import deliveries

    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        raise StopIteration

    monkeypatch.setattr(deliveries, "staged", noted)
    raw = getattr(deliveries, make).__closure__
    function = next(c.cell_contents for c in raw if callable(c.cell_contents))
    with pytest.raises(StopIteration):
        function(spark, folder)
    assert plans[label].count("l_suppkey") and plans[label].count("Relation [l_orderkey") == 1
