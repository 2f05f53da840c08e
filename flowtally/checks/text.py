"""Scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import names as N
from ..functions import text as X
from ..functions.nulls import half_even, lenient_sum, strict_if
from ..plans.deliveries import checked_staff
from ..session import new_folder
from ..sources import tables as T
from ..sources.files import read_rows
from .registry import check


@check("O79", sql="""SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN regexp_matches(p_name, 'red') THEN 'Red'
    WHEN regexp_matches(p_name, '(?i)RING$') THEN 'Ring' WHEN p_name = 'small widget' THEN NULL ELSE p_name END AS name FROM part""")
def first_rule_wins(spark, folder):
    named = T.table(spark, folder, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("name"))
    rules = [("red", "Red"), ("(?i)RING$", "Ring")]
    return named.withColumn("name", X.apply_rules("name", rules, {"small widget": None}))


def _spelled(spark, folder, spellings: list[str]):
    """Orders with one of the given spellings each."""
    n = F.lit(len(spellings))
    pick = F.element_at(F.lit(spellings), (F.col("o_orderkey") % n + 1).cast("int"))
    return T.table(spark, folder, "orders").select("o_orderkey", pick.alias("raw"))


def _spelled_sql(names: list[str | None]) -> str:
    cases = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(names)
    )
    return f"SELECT o_orderkey, CASE o_orderkey % {len(names)} {cases} END AS name FROM orders"


DESTINATIONS = {
    "CONGO, THE DEMOCRATIC REPUBLIC OF THE": "Congo DR",
    "kosovo*": "Kosovo",
    "MOLDOVA, REPUBLIC OF": "Moldova",
    "syrian arab republic": "Syria",
    "SYRIA (ARAB REPUBLIC)": "Syria",
    "RUSSIAN FEDERATION": "Russia",
    "BOSNIA AND HERZEGOVINA": "Bosnia and Herzegovina",
    "GUINEA-BISSAU": "Guinea-Bissau",
    "CÔTE D'IVOIRE": "Côte D'ivoire",
    "CONGO": "Congo",
}


@check("O79", "O84", "O86", sql=_spelled_sql(list(DESTINATIONS.values())))
def destination_names(spark, folder):
    return _spelled(spark, folder, list(DESTINATIONS)).select("o_orderkey", N.destination("raw").alias("name"))


PAYEES = {
    "GERMANY (OBSERVER)": "Germany",
    "FX MISSIONS": "Frontex",
    "fx mission 3": "Frontex",
    "UK_OBSERVERS": "United Kingdom",
    "THE NETHERLANDS_CANCELLED": "Netherlands",
    "GERAMNY": "Germany",
    "Spain_jcc with AT": "Spain",
    "FRANCE OBS": "France",
    "Italy_rf": "Italy",
    "GR": "Gr",
}


@check("O79", "O85", "O86", sql=_spelled_sql(list(PAYEES.values())))
def payee_names(spark, folder):
    return _spelled(spark, folder, list(PAYEES)).select("o_orderkey", N.payee("raw").alias("name"))


STATES = {
    "FRONTEX staff": "Frontex",
    "UK (observer)": "United Kingdom",
    "ltaly": "Italy",
    "luxembourgh": "Luxembourg",
    "Austria (observer)": "Austria",
    "Spain (Ombudsman)": "Spain",
    "N/A": None,
    "Malta": "Malta",
}


@check("O79", "O86", "O87", sql=_spelled_sql(list(STATES.values())))
def state_names(spark, folder):
    return _spelled(spark, folder, list(STATES)).select("o_orderkey", N.state_2006("raw").alias("name"))


@check("O80", sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END AS band FROM orders""")
def strict_choice(spark, folder):
    price = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice"))
    return T.table(spark, folder, "orders").select("o_orderkey", strict_if(price > 200000, F.lit("high"), F.lit("low")).alias("band"))


@check("O81", sql="SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE value END AS value FROM events")
def missing_to_zero(spark, folder):
    value = F.when(F.col("event_id") % 4 != 0, F.col("value"))
    return T.table(spark, folder, "events").select("event_id", F.coalesce(value, F.lit(0.0)).alias("value"))


@check("O82", sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority WHEN o_orderkey % 2 = 0 THEN 'VRD' ELSE 'unknown' END AS op_type FROM orders""")
def default_type(spark, folder):
    """Missing types are named by the id; others are trimmed."""
    op_id = F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit("VRD-")).otherwise(F.lit("RO-")), F.col("o_orderkey").cast("string"))
    raw = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit(" "), "o_orderpriority", F.lit("\t ")))
    return T.table(spark, folder, "orders").select("o_orderkey", N.operation_type(raw, op_id).alias("op_type"))


@check("O83", sql="""WITH l AS (SELECT l_orderkey, sum(l_quantity) AS parts, CASE WHEN l_orderkey % 5 <> 0 THEN sum(l_linenumber) * 8.0 END AS total
      FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CAST(CASE WHEN parts > total THEN parts ELSE total END AS DOUBLE) AS total,
      coalesce(parts >= total, FALSE) AS agrees FROM l""")
def larger_of_two(spark, folder):
    """Sum of parts against a stated total, and whether the result is the sum."""
    lines = T.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        lenient_sum("l_quantity").alias("parts"), (F.sum("l_linenumber") * 8.0).alias("total")
    )
    gappy = lines.withColumn("total", F.when(F.col("l_orderkey") % 5 != 0, F.col("total")))
    return checked_staff(gappy, ["parts"], "total", "agrees").select("l_orderkey", "total", "agrees")


# Character by character: upper case after anything that does not continue a word.
TITLE = """SELECT doc_id, md5(array_to_string([
      CASE WHEN regexp_matches(p[1], '^\\p{L}') AND NOT regexp_matches(p[2], '[\\p{L}\\p{N}_'']$')
           THEN replace(upper(p[1]), 'ẞ', 'SS') ELSE p[1] END
      FOR p IN list_zip(chars, list_prepend(' ', chars[:-2]))], '')) AS title
    FROM (SELECT doc_id, string_split(lower(text), '') AS chars FROM documents)"""


@check("O84", sql=TITLE)
def title_case_texts(spark, folder):
    """Whole documents; a digest stands for the text."""
    return T.table(spark, folder, "documents").select("doc_id", F.md5(X.title_case("text")).alias("title"))


@check("O85", sql="SELECT conv_id, turn, replace(upper(trim(text, ' ' || chr(9) || chr(10) || chr(13))), 'ẞ', 'SS') AS text FROM conversations")
def upper_trimmed(spark, folder):
    padded = F.concat(F.lit(" \t"), "text", F.lit(" \r\n"))
    return T.table(spark, folder, "conversations").select("conv_id", "turn", F.upper(X.trimmed(padded)).alias("text"))


@check("O86", sql="""SELECT doc_id, md5(regexp_replace(text, '[aeiou]+', '')) AS first_gone, md5(regexp_replace(text, '[aeiou]+', '', 'g')) AS all_gone,
    md5(regexp_replace(regexp_replace(text, 'th', 'TH', 'g'), 'T', 't', 'g')) AS swapped FROM documents""")
def pattern_removal(spark, folder):
    """First match, all matches, and several replacements in turn, on whole documents."""
    return T.table(spark, folder, "documents").select(
        "doc_id",
        F.md5(X.remove_first("text", "[aeiou]+")).alias("first_gone"),
        F.md5(X.remove_all("text", "[aeiou]+")).alias("all_gone"),
        F.md5(X.replace_patterns("text", {"th": "TH", "T": "t"})).alias("swapped"),
    )


@check("O88", sql="""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS digits,
    regexp_extract(c_name, '^(\\d*)', 1) AS none FROM customer""")
def leading_digits(spark, folder):
    raw = F.when(F.col("c_custkey") % 3 == 0, F.lit("no number 7")).otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(" a2")))
    return T.table(spark, folder, "customer").select(
        "c_custkey", X.leading_digits(raw).alias("digits"), X.leading_digits("c_name").alias("none")
    )


@check("O89", sql="SELECT doc_id, substr(text, 10, 14) AS middle, right(text, 13) AS tail, length(text) AS n FROM documents")
def text_positions(spark, folder):
    return T.table(spark, folder, "documents").select(
        "doc_id",
        X.between_positions("text", 10, 23).alias("middle"),
        X.last_chars("text", 13).alias("tail"),
        F.length("text").cast("long").alias("n"),
    )


@check("O91", sql="SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS price FROM orders")
def currency_text(spark, folder):
    """Amounts written with a euro sign, thousands commas and a stray blank."""
    digits = F.format_number(F.col("o_totalprice").cast("decimal(14,2)"), 2)
    text = F.concat(F.lit("€      "), F.left(digits, F.lit(1)), F.lit(" "), F.substring(digits, 2, 40))
    raw = F.when(F.col("o_orderkey") % 17 == 0, F.lit("€     -")).otherwise(text)
    return T.table(spark, folder, "orders").select("o_orderkey", X.money_value(raw).cast("double").alias("price"))


@check("O91", sql="SELECT o_orderkey, o_orderkey % 9 AS kind FROM orders WHERE o_orderkey % 9 IN (1, 2, 3)")
def amount_quarantine(spark, folder):
    """Amounts too large, with digits beyond the fourth decimal, or with other signs among them."""
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    kind = F.col("o_orderkey") % 9
    raw = (
        F.when(kind == 1, F.concat(F.lit("9" * 25), price))
        .when(kind == 2, F.concat(price, F.lit("001")))
        .when(kind == 3, F.concat(price, F.lit(" approx.")))
        .when(kind == 4, F.lit("€ -"))
        .when(kind == 5, F.concat(F.lit("12345678901"), price))
        .otherwise(F.concat(F.lit("€ "), price))
    )
    return T.table(spark, folder, "orders").where(X.unfit_amount(raw)).select("o_orderkey", kind.alias("kind"))


@check("O2", sql="SELECT c_custkey, CAST(c_custkey AS VARCHAR) || ',' || c_name || ',x,y' AS line FROM customer WHERE c_custkey % 13 = 0")
def field_quarantine(spark, folder):
    """Lines with fields beyond the header, kept whole."""
    path = new_folder(spark, "long-lines")
    rows = T.table(spark, folder, "customer").select(
        F.concat_ws(",", "c_custkey", "c_name", *[F.when(F.col("c_custkey") % 13 == 0, F.lit(x)) for x in "xy"]).alias("value")
    )
    rows.write.text(path)
    lines = read_rows(spark, path, ["c_custkey", "c_name"], header=False, quarantine="line")
    return lines.where("line IS NOT NULL").select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "line")


@check("O92", "O99", sql="SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 1 THEN o_totalprice END AS price FROM orders")
def number_text(spark, folder):
    text = F.element_at(
        F.array(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")), F.lit("n/a"), F.col("o_totalprice").cast("string"), F.concat(F.col("o_totalprice").cast("string"), F.lit("\r"))),
        (F.col("o_orderkey") % 4 + 1).cast("int"),
    )
    return T.table(spark, folder, "orders").select("o_orderkey", X.number_value(text).alias("price"))


@check("O93", sql="SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 5 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def date_texts(spark, folder):
    """Five notations of one date, and texts that are none."""
    day = F.col("o_orderdate")
    notations = [F.date_format(day, f) for f in ("dd/MM/yyyy", "yyyy-MM-dd", "d-M-yyyy", "dd.MM.yyyy", "yyyy/MM/dd")]
    raw = F.element_at(F.array(*notations, F.lit("unknown")), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return T.table(spark, folder, "orders").select("o_orderkey", D.parse_date(raw).alias("day"))


@check("O93", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_range_ends(spark, folder):
    """The last day of a range at the end of a text, or a single date there."""
    end = F.date_format("o_orderdate", "dd/MM/yyyy")
    # '01-02/02/2008' in 13 characters: here the range ends on the date's own day
    range_text = F.concat(F.left(end, F.lit(2)), F.lit("-31"), F.substring(end, 3, 8))
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Charter to "), end)).otherwise(F.concat(F.lit("JRO x "), range_text))
    return T.table(spark, folder, "orders").select("o_orderkey", D.range_end(raw).alias("day"))


@check("O94", sql="""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 4) AS INTEGER) AS text_year FROM orders""")
def years(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return T.table(spark, folder, "orders").select("o_orderkey", D.year_of(day).alias("year"), D.year_of_text(day).alias("text_year"))


@check("O95", "O97", sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN make_date(year(o_orderdate), 12, 31) ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def missing_date_to_year_end(spark, folder):
    day = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate").cast("date"))
    return T.table(spark, folder, "orders").select("o_orderkey", D.or_year_end(day, F.year("o_orderdate")).alias("day"))


@check("O96", sql="SELECT l_orderkey, l_linenumber, sum(round_even(l_quantity / 8, 2)) AS n FROM lineitem GROUP BY ALL")
def round_half_even(spark, folder):
    lines = T.table(spark, folder, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.sum(half_even(F.col("l_quantity") / 8, 2)).alias("n"))


@check("O98", sql="""SELECT o_orderkey, '€' || replace(format('{:,}', CAST(round(CAST(o_totalprice AS DECIMAL(14,2)), 0) AS BIGINT)), ',', '.') AS shown,
    '€' || translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS exact FROM orders""")
def displayed_amounts(spark, folder):
    return T.table(spark, folder, "orders").select(
        "o_orderkey", X.display_amount("o_totalprice").alias("shown"), X.display_amount("o_totalprice", 2).alias("exact")
    )
