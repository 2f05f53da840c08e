"""Tidy tables from raw deliveries: returns, staff, costs, representatives and sheets.

Raw rows are text with `src_file`, `src_block`, `src_row` (see sources.files).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.dates import DAY_FIRST, YEAR_FIRST, or_year_end, parse_date
from ..functions.nulls import matches, strict_if
from ..functions.text import between_positions, money_value, number_value, replace_patterns, title_case
from ..operators.columns import add_row_sum, columns_like, map_columns, quoted
from ..operators.joins import join_on
from ..operators.ordered import fill_down, number_rows
from ..operators.reshape import slots_to_rows
from ..sources.files import ROW_ORDER

# Column layouts of the 2019-21 tables, by position.
RETURN_COLUMNS = ["op_id", "date_type", "blank", "origin", "dest", "shifted", "n"]
STAFF_COLUMNS = [
    "blank", "op_id", "op_date", "origin", "n_esc_lead", "n_esc", "freso_ap_cat_1", "freso_ap_cat_2",
    "freso_hq_cat_1", "freso_hq_cat_2", "freso_cat_3", "n_meds", "n_obs_ms", "n_obs_tc",
    "n_monitors_nat", "n_monitors_pool_ms", "n_monitors_fx",
]
COST_COLUMNS = ["op_id", "op_date", "iso", "amount"]
REPRESENTATIVE_COLUMNS = ["op_id", "op_date", "n_staff"]
# The same tables by heading, for `headers.scan_by_header`.
COST_HEADERS = {"op_id": ["RO-ID"], "op_date": ["Date"], "iso": ["MS/SAC"], "amount": ["TOTAL PAID"]}
REPRESENTATIVE_HEADERS = {"op_id": ["RO-ID"], "op_date": ["RO Date"], "n_staff": ["Frontex Representative on Board"]}
NEWER_RETURN_COLUMNS = ["op_id", "op_date", "origin", "dest", "n"]
NEWER_TYPE_COLUMNS = ["op_date", "op_type", "op_id"]
ID_HEADER, STATE_HEADER, SUBTOTAL = "RO-ID", "MSSAC", "Total"

# Column groups of the 2006-18 sheets.
SLOTS = {
    "n": ["Returnees (1)", "Returnees (2)", "Returnees (3)"],
    "dest": ["Destination (1)", "Destination (2)", "Destination (3)"],
    "n_esc": ["Escorts (1)", "Escorts (2)", "Escorts (3)"],
    "n_esc_lead": ["Escort leaders (1)", "Escort leaders (2)", "Escort leaders (3)"],
}


def newer_returns(rows: DataFrame) -> DataFrame:
    """op_id, op_date, origin, dest, n from the newer deliveries, whose columns go by position.

    Several deliveries are read together; names are in title case, destinations by their rules.
    """
    return rows.select(
        "op_id",
        parse_date("op_date", YEAR_FIRST + DAY_FIRST).alias("op_date"),
        title_case("origin").alias("origin"),
        names.destination("dest").alias("dest"),
        number_value("n").alias("n"),
    )


def newer_types(rows: DataFrame) -> DataFrame:
    """op_id, op_type for `cubes.operations`; the types' own dates differ and are left out."""
    return rows.select("op_id", "op_type")


def data_rows(rows: DataFrame) -> DataFrame:
    """Rows that carry a count: no subtotals, repeated headers, footnotes or blank counts."""
    return rows.where(
        ~matches("op_id", names_pattern(SUBTOTAL)) & (F.col("origin") != STATE_HEADER) & number_value("n").isNotNull()
    )


def names_pattern(text: str) -> str:
    return r"\Q" + text + r"\E"


def tidy_returns(rows: DataFrame, order: Sequence[str] = ROW_ORDER, id_length: int = 8) -> DataFrame:
    """op_id, op_date, op_type, origin, dest, n from a table with continuation rows.

    Id, date and type are written once per operation and filled down among the data
    rows. Where the page break merged date and type into the id cell, they are cut out
    of its tail first: ids have `id_length` characters, the rest follows after a blank.
    """
    merged = F.col("date_type").isNull() & F.col("op_id").isNotNull()
    date_type = strict_if(merged, between_positions("op_id", id_length + 2, id_length + 15), F.col("date_type"))
    op_id = strict_if(F.length("op_id") > id_length, between_positions("op_id", 1, id_length), F.col("op_id"))
    cut = data_rows(rows).withColumns({"date_type": date_type, "op_id": op_id})
    split = cut.withColumns(
        {"op_date": between_positions("date_type", 1, 10), "op_type": between_positions("date_type", 12, 14)}
    )
    filled = fill_down(split, ["op_id", "op_date", "op_type"], order, ["src_file"])
    return filled.select(
        "op_id",
        parse_date("op_date", DAY_FIRST).alias("op_date"),
        "op_type",
        "origin",
        names.destination_2019("dest").alias("dest"),
        number_value("n").alias("n"),
    )


def shifted_returns(rows: DataFrame, overflow: str = "overflow") -> DataFrame:
    """Quarantine: rows whose count stands one field too far right and is not in the tidy table."""
    return rows.where(number_value("n").isNull() & number_value(overflow).isNotNull() & F.col("origin").isNotNull())


def subtotal_differences(rows: DataFrame, order: Sequence[str] = ROW_ORDER, id_length: int = 8) -> DataFrame:
    """Operations whose delivered subtotal is not the sum of their rows."""
    subtotal = rows.where(matches("op_id", names_pattern(SUBTOTAL))).select(
        between_positions("op_id", 1, id_length).alias("op_id"), number_value("n").alias("stated")
    )
    stated = subtotal.groupBy("op_id").agg(F.sum("stated").alias("stated"))
    summed = tidy_returns(rows, order, id_length).groupBy("op_id").agg(F.sum("n").alias("summed"))
    both = join_on(summed, stated, "op_id", "full")
    return both.where(~F.col("summed").eqNullSafe(F.col("stated")))


def without_headers(rows: DataFrame) -> DataFrame:
    """Drop header lines repeated on every page, and rows without an id."""
    return rows.where(F.col("op_id") != ID_HEADER)


def representatives(rows: DataFrame) -> DataFrame:
    """op_id, op_date, n_staff."""
    return without_headers(rows).select("op_id", parse_date("op_date", DAY_FIRST).alias("op_date"), number_value("n_staff").alias("n_staff"))


def staff(rows: DataFrame) -> DataFrame:
    """Counts per operation and state with derived totals of monitors, observers and escorts."""
    counts = STAFF_COLUMNS[4:]
    typed = map_columns(without_headers(rows).select(*STAFF_COLUMNS[1:]), counts, number_value)
    typed = typed.withColumn("op_date", parse_date("op_date", DAY_FIRST))
    out = add_row_sum(typed, "n_monitors", columns_like(typed, "^n_monitors_"))
    out = add_row_sum(out, "n_obs", columns_like(out, "^n_obs_"))
    return add_row_sum(out, "n_esc_obs_med", columns_like(out, "n_obs$|n_esc|n_meds"))


def costs(rows: DataFrame) -> DataFrame:
    """op_id, op_date, iso, amount."""
    return without_headers(rows).select(
        "op_id", parse_date("op_date", DAY_FIRST).alias("op_date"), "iso", money_value("amount").alias("amount")
    )


def staff_and_costs(cost_rows: DataFrame, staff_rows: DataFrame, countries: DataFrame) -> DataFrame:
    """Costs and staff side by side per operation, date and state; each may lack the other."""
    codes = countries.select(replace_patterns("name", names.COUNTRY_SYNONYMS_2021).alias("origin"), "iso")
    paid = join_on(costs(cost_rows), codes, "iso")
    present = join_on(staff(staff_rows), codes, "origin")
    return join_on(paid, present, ["iso", "origin", "op_id", "op_date"], "full")


def sheet_headers(rows: DataFrame, countries: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """2006-18 sheets: ids, canonical state with code, upper-case type and checked staff total.

    `rows` holds typed sheet columns with year, number, op_date, origin, op_type,
    n_esc_obs_med, n_meds, n_obs and the slot columns.
    """
    numbered = number_rows(rows, "line", order, ["year"])
    ids = numbered.withColumns(
        {
            "id": F.concat_ws("_", "year", "number"),
            "row_id": F.concat(F.col("year").cast("string"), F.lit("_"), F.col("line").cast("string")),
            "origin": names.state_2006("origin"),
            "op_type": F.upper("op_type"),
        }
    ).withColumn("id", F.when(F.col("number").isNotNull(), F.col("id")))
    coded = join_on(ids, countries.select(F.col("name").alias("origin"), "iso"), "origin")
    return checked_staff(coded, [*SLOTS["n_esc"], *SLOTS["n_esc_lead"], "n_meds", "n_obs"])


def checked_staff(df: DataFrame, parts: Sequence[str], total: str = "n_esc_obs_med", flag: str = "staff_agrees") -> DataFrame:
    """Take the sum of the parts where it is larger than the stated total, and say whether they agree.

    A missing total stays missing and does not agree.
    """
    summed = add_row_sum(df, "__sum", parts)
    best = F.when(F.col("__sum") > F.col(total), F.col("__sum")).otherwise(F.col(total))
    agrees = F.coalesce(F.col("__sum") == F.col(total), F.lit(False))
    return summed.withColumn(total, best.cast("double")).withColumn(flag, agrees).drop("__sum")


def sheet_operations(headers: DataFrame) -> DataFrame:
    """One row per sheet line without the slot columns; a missing date becomes the year's last day."""
    slot_columns = [c for group in SLOTS.values() for c in group]
    out = headers.withColumn("op_date", or_year_end("op_date", F.col("year")))
    return out.drop(*slot_columns, "staff_agrees", "line", "number")


def sheet_destinations(headers: DataFrame) -> DataFrame:
    """row_id, slot, n, dest, n_esc, n_esc_lead, staff_agrees: one row per filled slot.

    The flag is known only where the slot states a number of escorts.
    """
    named = headers.withColumns({c: names.destination_2006(quoted(c)) for c in SLOTS["dest"]})
    out = slots_to_rows(named, ["row_id", "staff_agrees"], SLOTS)
    return out.withColumn("staff_agrees", F.when(F.col("n_esc").isNotNull(), F.col("staff_agrees")))
