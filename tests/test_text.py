import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowtally.functions import dates as D
from flowtally.functions import names as N
from flowtally.functions import text as X


def apply(spark, fn, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("GERMANY (OBSERVER)", "Germany (Observer)"),
        ("GUINEA-BISSAU", "Guinea-Bissau"),
        ("UK_OBSERVERS", "Uk_observers"),
        ("CÔTE D'IVOIRE", "Côte D'ivoire"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, raw, expected):
    assert apply(spark, X.title_case, raw) == [expected]


def test_padding_never_cuts(spark):
    assert apply(spark, lambda c: X.pad_left(c, 3), "7", "1234", "", None) == ["007", "1234", "000", None]


def test_operation_key_writes_missing_parts(spark):
    out = apply(spark, lambda c: X.operation_key(F.lit(2012), c), "7", None, "")
    assert out == ["RO-2012-007", "RO-2012-NA", "RO-2012-000"]


def test_first_and_all_matches(spark):
    assert apply(spark, lambda c: X.remove_first(c, "b"), "abcb", "xyz", None) == ["acb", "xyz", None]
    assert apply(spark, lambda c: X.remove_all(c, "b"), "abcb") == ["ac"]


def test_leading_digits(spark):
    assert apply(spark, X.leading_digits, "12 (x)", "no 7", None) == ["12", "", None]


def test_currency_text(spark):
    out = apply(spark, X.money_value, "€      4 9,883.90", "€     -", "€ 140.71", None, "1,234.56789")
    assert out == [Decimal("49883.9000"), None, Decimal("140.7100"), None, Decimal("1234.5679")]


def test_amounts_that_do_not_fit(spark):
    big = "1" * 20
    assert apply(spark, X.money_value, big, "1" * 30) == [Decimal(big), None]
    texts = ["1.23456", "€ 5.10", "1" * 30, "n/a", "€ -", None, "3 EUR", "7.1200000"]
    assert apply(spark, X.unfit_amount, *texts) == [True, False, True, False, False, False, True, False]


def test_number_text(spark):
    assert apply(spark, X.number_value, " 12.5\r", "-", "12f", "1e3", None, "") == [12.5, None, None, 1000.0, None, None]


def test_display(spark):
    out = apply(spark, lambda c: X.display_amount(c.cast("double")), "1234567.5", "2.5", "0", "-1234")
    assert out == ["€1.234.568", "€3", "€0", "-€1.234"]
    assert apply(spark, lambda c: X.display_amount(c.cast("double"), 2, ""), "1234.5") == ["1.234,50"]


def test_rules_first_match_then_exact_then_unchanged(spark):
    rule = lambda c: X.apply_rules(c, [("a", "A"), ("ab", "B")], {"x": None})
    assert apply(spark, rule, "ab", "x", "z", None) == ["A", None, "z", None]


def test_dates(spark):
    day = datetime.date(2008, 2, 1)
    assert apply(spark, D.parse_date, "01/02/2008", "2008-02-01", "1.2.2008", "on 1-2-2008", "2008-02-01T00:00:00Z") == [day] * 5
    assert apply(spark, D.parse_date, "31/02/2008", "none", "", None, "12345", "1/2/20081", "@2008-x") == [None] * 7
    assert apply(spark, lambda c: D.parse_date(c, D.DAY_FIRST), "2008-02-01", "01/02/2008") == [None, day]


def test_dates_with_names_or_without_separators(spark):
    day = datetime.date(2008, 3, 1)
    texts = ["01/03/08", "1 March 2008", "1st of march 2008", "01032008", "20080301", "1-Mar-2008", "JRO 1.3.08"]
    assert apply(spark, D.parse_date, *texts) == [day] * len(texts)
    assert apply(spark, D.parse_date, "01/03/69", "31/02/08", "3 of 12 in 45", "1 Mai 2008") == [datetime.date(1969, 3, 1), None, None, None]
    df = spark.createDataFrame([("01/03/08",), ("soon",), (None,)], "day string")
    assert [r.day for r in D.unread_dates(df, "day").collect()] == ["soon"]


def test_date_range_end(spark):
    out = apply(spark, D.range_end, "01-02/02/2008", "JRO Lagos 01-02/02/2008", "JRO 02/02/2008", None)
    first, second = datetime.date(2008, 2, 1), datetime.date(2008, 2, 2)
    assert out == [first, first, second, None]


def test_missing_date_becomes_year_end(spark):
    out = apply(spark, lambda c: D.or_year_end(c.cast("date"), F.lit(2009)), "2009-03-04", None)
    assert out == [datetime.date(2009, 3, 4), datetime.date(2009, 12, 31)]


def test_destination_names(spark):
    raw = ["CONGO, THE DEMOCRATIC REPUBLIC OF THE", "KOSOVO*", "bosnia and herzegovina", "MOLDOVA, REPUBLIC OF", None]
    assert apply(spark, N.destination, *raw) == ["Congo DR", "Kosovo", "Bosnia and Herzegovina", "Moldova", None]
    assert apply(spark, N.destination_2006, "Congo-Brazzaville", "x", "Mali") == ["Congo DR", None, "Mali"]
    assert apply(spark, N.destination_2019, "Kosovo*", "The Gambia") == ["Kosovo", "Gambia"]


def test_payee_names(spark):
    raw = ["GERMANY (OBSERVER)", "FX missions", "UK", "netherlands_cancelled", "Geramny", "SPAIN_JCC WITH AT", "be, ro,si"]
    out = ["Germany", "Frontex", "United Kingdom", "Netherlands", "Germany", "Spain", "Be, Ro,Si"]
    assert apply(spark, N.payee, *raw) == out
    assert apply(spark, N.payee_2016, "Gr", "FYR Macedonia", "germany x") == ["Greece", "North Macedonia", "Germany"]


def test_state_names(spark):
    raw = ["frontex", "UK (observer)", "Austria (observer)", "Spain (Ombudsman)", "N/A", "Malta", None]
    assert apply(spark, N.state_2006, *raw) == ["Frontex", "United Kingdom", "Austria", "Spain", None, "Malta", None]


def test_operation_types(spark):
    df = spark.createDataFrame([(" JRO ", "RO-1"), (None, "VRD-1"), (None, "RO-2"), (None, None)], "t string, id string")
    assert [r[0] for r in df.select(N.operation_type("t", "id")).collect()] == ["JRO", "VRD", "unknown", "unknown"]
