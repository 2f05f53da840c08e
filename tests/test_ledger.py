import datetime
from decimal import Decimal

import pytest

from flowtally.plans import ledger as L

COUNTRIES = [("Germany", "DEU"), ("Czechia", "CZE"), ("Slovak Republic", "SVK"), ("United Kingdom", "GBR"), ("Greece", "GRC")]


@pytest.fixture()
def countries(spark):
    return spark.createDataFrame(COUNTRIES, "name string, iso string")


def table(spark, year, names, rows):
    full = [(year, "f", i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "year int, src_file string, src_row long, " + ", ".join(f"{n} string" for n in names))


def out(df):
    return [tuple(r) for r in df.orderBy("op_id", "payee", "amount").collect()]


def test_dated_layout(spark, countries):
    rows = table(
        spark, 2008, ["info", "payee", "amount"],
        [
            ("JRO Lagos 01-02/02/2008", "GERMANY", "10.5"),
            (None, "czech republic", "3"),
            (None, "TOTAL COST", "13.5"),
            ("JRO Kabul 05/03/2008", "FX MISSIONS", "7"),
            (None, "BE, RO,SI", "9"),
            (None, None, "4"),
            (None, "Malta", "-"),
        ],
    )
    ops = spark.createDataFrame([("A", datetime.date(2008, 2, 1)), ("B", datetime.date(2008, 3, 5))], "op_id string, op_date date")
    assert out(L.dated_ledger(rows, ops, countries, ["src_row"])) == [
        ("A", datetime.date(2008, 2, 1), 2008, "Czech Republic", "CZE", Decimal("3.0000")),
        ("A", datetime.date(2008, 2, 1), 2008, "Germany", "DEU", Decimal("10.5000")),
        ("B", datetime.date(2008, 3, 5), 2008, "Frontex", "FX", Decimal("7.0000")),
    ]


def test_numbered_and_keyed_layouts(spark, countries):
    rows = table(
        spark, 2012, ["number", "payee", "n_escorts", "amount"],
        [("7 (x)", "UK_OBSERVERS", "1", "2"), (None, "Slovakia", "1", "0"), (None, "Sum", "1", "5"), ("1234", "Geramny", None, "1")],
    )
    assert out(L.numbered_ledger(rows, countries, ["src_row"])) == [
        ("RO-2012-007", None, 2012, "United Kingdom", "GBR", Decimal("2.0000")),
        ("RO-2012-1234", None, 2012, "Germany", "DEU", Decimal("1.0000")),
    ]
    rows = table(spark, 2015, ["op_id", "payee", "n_escorts", "amount"], [("RO-2015-1", "Slovakia", None, "1"), (None, "Chad", None, "2")])
    assert out(L.keyed_ledger(rows, countries, ["src_row"])) == [
        ("RO-2015-1", None, 2015, "Chad", None, Decimal("2.0000")),
        ("RO-2015-1", None, 2015, "Slovakia", "SVK", Decimal("1.0000")),
    ]


def test_dated_numbered_layout(spark, countries):
    rows = table(
        spark, 2016, ["number", "payee", "op_date", "amount"],
        [("12", "GR", "2016-02-03", "2"), (None, "RO TO X", "2016-02-03", "2"), (None, "Ro Nigeria", "2016-02-03", "2"), (None, None, "2016-02-03", "2")],
    )
    day = datetime.date(2016, 2, 3)
    assert out(L.dated_numbered_ledger(rows, countries, ["src_row"])) == [("RO-2016-012", day, 2016, "Greece", "GRC", Decimal("2.0000"))]


def test_named_and_coded_layouts(spark, countries):
    rows = table(spark, 0, ["op_date", "payee", "op_id", "amount"], [("2017-01-02", "Germany", "R1", "-2"), ("2017-01-03", "Chad", "R2", None)])
    assert out(L.named_ledger(rows, countries)) == [
        ("R1", datetime.date(2017, 1, 2), 2017, "Germany", "DEU", Decimal("-2.0000")),
        ("R2", datetime.date(2017, 1, 3), 2017, "Chad", None, None),
    ]
    rows = table(
        spark, 0, ["op_date", "op_id", "iso", "amount"],
        [("03/04/2019", "R1", "FX", "2"), ("03/04/2019", "R2", "SVK", "2.00005"), ("03/04/2019", "R3", None, "1"), (None, "R4", "DEU", "1"), ("03/04/2019", "R5", "DEU", "0")],
    )
    day = datetime.date(2019, 4, 3)
    assert out(L.coded_ledger(rows, countries)) == [
        ("R1", day, 2019, "Frontex", "FX", Decimal("2.0000")),
        ("R2", day, 2019, "Slovakia", "SVK", Decimal("2.0001")),
        ("R3", day, 2019, None, None, Decimal("1.0000")),
    ]


def test_whole_ledger_feeds_the_cubes(spark, countries):
    from flowtally.plans.cubes import yearly_contributions

    rows = table(spark, 2012, ["number", "payee", "n_escorts", "amount"], [("7", "Slovakia", "1", "2"), ("8", "Germany", "1", "5")])
    ledger = L.whole_ledger(L.numbered_ledger(rows, countries, ["src_row"]))
    cube = yearly_contributions(ledger)
    assert cube.columns == ["year", "payee", "Germany", "Slovakia"]
    assert sorted(tuple(r) for r in cube.collect()) == [
        (2012, "Germany", 5.0, 0.0),
        (2012, "Slovakia", 0.0, 2.0),
        (2012, "all EU member states", 5.0, 2.0),
    ]


def test_spellings_are_written_before_they_are_cleaned(spark, countries, monkeypatch):
    """Filters on cleaned names must not sink below the distinct, where they would clean every row."""
    plans = {}

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, label)

    staged = L.staged
    monkeypatch.setattr(L, "staged", noted)
    rows = spark.createDataFrame([("keyed", "Germany"), ("keyed", "Germany"), ("keyed", "TOTAL COST"), ("keyed", None)], "layout string, payee string")
    assert [r.written for r in L.payee_table(rows, countries).collect()] == ["Germany"]
    assert "Aggregate" in plans["spellings"] and "regexp" not in plans["spellings"] and "Aggregate" not in plans["payees"]
