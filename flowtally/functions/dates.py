"""Date parsing and years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nulls import as_col
from .text import last_chars, remove_first

# Order of the parts in a text; between them stands anything but digits, or nothing where
# the text is eight digits. A month may be a name, a year may have two digits.
DAY_FIRST = ("dmy", "d month y", "dmy compact", "dmy short")
YEAR_FIRST = ("ymd", "ymd compact")
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_SHAPES = {
    "dmy": (r"(?s)^\D*(\d{1,2})\D+(\d{1,2})\D+(\d{4})(?!\d).*$", "@$3-$2-$1"),
    "dmy short": (r"(?s)^\D*(\d{1,2})[./ -]+(\d{1,2})[./ -]+(\d{2})(?!\d).*$", "@$3-$2-$1"),
    "dmy compact": (r"(?s)^\D*(\d{2})(\d{2})((?:19|20)\d{2})(?!\d).*$", "@$3-$2-$1"),
    "ymd": (r"(?s)^\D*(\d{4})\D+(\d{1,2})\D+(\d{1,2})(?!\d).*$", "@$1-$2-$3"),
    "ymd compact": (r"(?s)^\D*((?:19|20)\d{2})(\d{2})(\d{2})(?!\d).*$", "@$1-$2-$3"),
    "d month y": (r"(?s)^\D*(\d{1,2})\D*\b(" + "|".join(_MONTHS) + r")\p{L}*\W*(\d{4})(?!\d).*$", "@$3-$2-$1"),
}


def parse_date(c: Column | str, orders: Sequence[str] = DAY_FIRST + YEAR_FIRST) -> Column:
    """Date in the first order of parts that fits the text; NULL when none does.

    Words before the date are skipped, and any separators will do. English month names
    count from their first three letters. Years of two digits lie from 1969 to 2068.
    """
    return F.coalesce(*[_in_shape(as_col(c), order) for order in orders])


def _in_shape(c: Column, order: str) -> Column:
    # the mark in front is there only if the shape fitted
    if order == "d month y":
        shape, parts = _SHAPES[order]
        text = F.regexp_replace(F.lower(c), shape, parts)
        month = F.regexp_extract(text, r"^@\d+-([a-z]{3})-\d+$", 1)
        number = F.array_position(F.lit(_MONTHS), month).cast("string")
        return F.try_to_date(F.regexp_replace(text, r"-[a-z]{3}-", F.concat(F.lit("-"), number, F.lit("-"))), "'@'yyyy-M-d")
    text = F.regexp_replace(c, *_SHAPES[order])
    if order == "dmy short":
        year = F.regexp_extract(text, r"^@(\d{2})-", 1)
        century = F.when(year >= "69", F.lit("@19")).otherwise(F.lit("@20"))
        return F.try_to_date(F.regexp_replace(text, r"^@(?=\d{2}-)", century), "'@'yyyy-M-d")
    return F.try_to_date(text, "'@'yyyy-M-d")


def unread_dates(df: DataFrame, column: str, orders: Sequence[str] = DAY_FIRST + YEAR_FIRST) -> DataFrame:
    """Quarantine: rows with a text in `column` that is read as no date.

    To be looked at ahead of a fill-down, which would put another row's date there.
    """
    return df.where(as_col(column).isNotNull() & parse_date(column, orders).isNull())


def range_end(c: Column | str) -> Column:
    """Last day of a date range written at the end of a text, e.g. 'JRO x 01-02/02/2008'.

    The tail of 13 characters holds the range; its '-' and the digits after it go.
    """
    return parse_date(remove_first(last_chars(c, 13), r"-\d*"), DAY_FIRST)


def year_of(c: Column | str) -> Column:
    return F.year(as_col(c))


def year_of_text(c: Column | str) -> Column:
    """Year in the first four characters of a date text, NULL if they are no number."""
    return F.substring(as_col(c).cast("string"), 1, 4).try_cast("int")


def or_year_end(date: Column | str, year: Column) -> Column:
    """A missing date becomes 31 December of the delivery's year."""
    return F.coalesce(as_col(date).cast("date"), F.make_date(year.cast("int"), F.lit(12), F.lit(31)))
