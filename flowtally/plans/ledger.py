"""One contribution ledger from deliveries in several layouts.

Raw rows carry `year` (of the delivery), `src_file`, `src_block`, `src_row` and text
columns as named below. Every layout ends as op_id, op_date, year, payee, iso, amount.

Merged cells are filled down inside their file only. Fill-down reads its input more
than once, so rows should come from a written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.dates import DAY_FIRST, YEAR_FIRST, parse_date, range_end
from ..functions.nulls import is_one_of, matches, strict_if
from ..functions.text import amount_value, leading_digits, operation_key, replace_patterns
from ..operators.joins import join_on, with_lookup
from ..operators.ordered import fill_down
from ..operators.reshape import union_by_name
from ..session import staged
from ..sources.files import ROW_ORDER

DATED, NUMBERED, KEYED, OWN_DATES = "dated", "numbered", "keyed", "own dates"
LEDGER = ["op_id", "op_date", "year", "payee", "iso", "amount"]


def country_codes(countries: DataFrame) -> DataFrame:
    """name, iso with the spellings used in the ledgers."""
    return countries.select(replace_patterns("name", names.COUNTRY_SYNONYMS).alias("name"), "iso")


def payee_table(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """written, own_dates, payee, iso for every spelling of a usable payee in the rows.

    Names are cleaned once per spelling instead of once per row: the spellings are written
    first, or Spark would move the filters on cleaned names below the distinct, to every row.
    The table is written too, so that Spark knows its size and can pick the join for it.
    """
    own = F.col("own_dates")
    spellings = rows.select(F.col("payee").alias("written"), (F.col("layout") == OWN_DATES).alias("own_dates"))
    spellings = staged(spellings.where(F.col("written").isNotNull()).distinct(), "spellings")
    named = spellings.withColumn("payee", F.when(own, names.payee_2016("written")).otherwise(names.payee("written")))
    usable = ~is_one_of("written", names.TOTAL_LABELS) & ~is_one_of("payee", names.UNUSABLE_PAYEES)
    usable_own = ~matches("payee", names.UNUSABLE_PAYEE_PATTERN_2016) & ~is_one_of("payee", names.UNUSABLE_PAYEES_2016)
    coded = with_lookup(named.where(F.when(own, usable_own).otherwise(usable)), "payee", country_codes(countries), "name", {"iso": "iso"})
    iso = strict_if(F.col("payee") == names.AGENCY, F.lit(names.AGENCY_CODE), F.col("iso"))
    return staged(coded.select("written", "own_dates", "payee", iso.alias("iso")), "payees")


def _with_payee(rows: DataFrame, payees: DataFrame) -> DataFrame:
    """Rows with an amount above 0 and a usable payee, cleaned and coded."""
    paid = rows.withColumn("amount", amount_value("amount")).where(F.col("amount") > 0)
    keyed = paid.withColumnsRenamed({"payee": "written"}).withColumn("own_dates", F.col("layout") == OWN_DATES)
    return join_on(keyed, payees, ["written", "own_dates"], "inner", null_safe=False).select(*LEDGER)


def dated_ledger(
    rows: DataFrame,
    operations: DataFrame,
    countries: DataFrame,
    order: Sequence[str] = ROW_ORDER,
    payees: DataFrame | None = None,
) -> DataFrame:
    """Layout DATED alone, see `merged_ledger`."""
    return merged_ledger(rows.withColumn("layout", F.lit(DATED)), countries, order, payees, operations)


def merged_ledger(
    rows: DataFrame,
    countries: DataFrame,
    order: Sequence[str] = ROW_ORDER,
    payees: DataFrame | None = None,
    operations: DataFrame | None = None,
) -> DataFrame:
    """Rows of the layouts with merged cells, told apart by `layout`, in one pass.

    * DATED `info, payee, amount`: a date range closes the merged info text;
    * NUMBERED `number, payee, n_escorts, amount`: a number within the year, maybe with text after it;
    * KEYED `op_id, payee, n_escorts, amount`: the full id;
    * OWN_DATES `number, payee, op_date, amount`: a number, and a date on every row.

    Operations of DATED rows are found by their date in `operations(op_id, op_date)`. Two
    operations on one date both take the row, so that table should hold one per date.
    `payees` is a ready `payee_table`, for several deliveries read apart.
    """
    missing = [c for c in ("info", "number", "op_id", "op_date") if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in missing})
    own, layout = F.col("layout") == OWN_DATES, F.col("layout")
    read = rows.withColumns(
        {
            "number": F.when(own, F.col("number")).when(layout == NUMBERED, leading_digits("number")),
            "op_id": F.when(layout == KEYED, F.col("op_id")),
            "range_end": F.when(layout == DATED, range_end("info")),
        }
    )
    filled = fill_down(read, ["number", "op_id", "range_end"], order, ["src_file"])
    built = operation_key(F.col("year"), F.col("number"))
    keyed = filled.withColumns(
        {
            "op_id": F.when(layout == KEYED, F.col("op_id")).when(layout != DATED, built),
            "op_date": F.when(own, parse_date("op_date", YEAR_FIRST)).otherwise(F.col("range_end")),
        }
    )
    if operations is not None:
        known = operations.select(F.col("op_date").alias("range_end"), F.col("op_id").alias("found"))
        keyed = join_on(keyed, known, "range_end", null_safe=False).withColumn("op_id", F.coalesce("op_id", "found"))
    return _with_payee(keyed, payees if payees is not None else payee_table(rows, countries))


def numbered_ledger(rows: DataFrame, countries: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    return merged_ledger(rows.withColumn("layout", F.lit(NUMBERED)), countries, order)


def keyed_ledger(rows: DataFrame, countries: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    return merged_ledger(rows.withColumn("layout", F.lit(KEYED)), countries, order)


def dated_numbered_ledger(rows: DataFrame, countries: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    return merged_ledger(rows.withColumn("layout", F.lit(OWN_DATES)), countries, order)


def named_ledger(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """Layout `op_date, payee, op_id, amount`, kept as delivered."""
    dated = rows.withColumn("op_date", _any_date("op_date")).withColumn("amount", amount_value("amount"))
    coded = with_lookup(dated, "payee", country_codes(countries), "name", {"iso": "iso"})
    return coded.withColumn("year", F.year("op_date")).select(*LEDGER)


def coded_ledger(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """Layout `op_date, op_id, iso, amount`: payees by code, the agency without a country."""
    dated = rows.withColumn("op_date", _any_date("op_date")).withColumn("amount", amount_value("amount"))
    named = with_lookup(dated, "iso", country_codes(countries), "iso", {"name": "payee"})
    payee = strict_if(F.col("iso") == names.AGENCY_CODE, F.lit(names.AGENCY), F.col("payee"))
    out = named.withColumn("payee", payee).withColumn("year", F.year("op_date"))
    return out.where((F.col("amount") > 0) & F.col("year").isNotNull()).select(*LEDGER)


def _any_date(c: str) -> Column:
    return parse_date(c, YEAR_FIRST + DAY_FIRST)


def whole_ledger(*parts: DataFrame) -> DataFrame:
    """All layouts under one another; `contribution` columns op_id, year, payee, amount feed the cubes."""
    return union_by_name(*parts)
