"""Column types of a text table, inferred from all its rows in one aggregate.

For each column the aggregate folds a small state: which of the candidate types still fit,
and how many digits stand before and behind the point. States merge in any order, so the
table is read once and one row comes out, whatever its size. The narrowest type that fits
every value wins: boolean, long, decimal with the widest scale found, double, a date in one
of the notations, text. Blank fields fit everything; a column without values stays text.

A number with leading zeros, such as a postal code or an id, is text. So is a column with
dates in more than one notation, as 01/02/2020 would otherwise be read by guess.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null, trimmed
from ..operators.columns import quoted

LONG = r"^[+-]?(0|[1-9]\d{0,17})$"
DECIMAL = r"^[+-]?(0|[1-9]\d*)(\.\d+)?$"
DOUBLE = r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[+-]?Infinity$|^NaN$"
BOOLEAN = r"(?i)^(true|false)$"
#: Notations of dates, in the order in which they are tried: shape of the text, Spark pattern.
NOTATIONS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "MM/dd/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "dd.MM.yyyy": r"^\d{2}\.\d{2}\.\d{4}$",
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "yyyyMMdd": r"^(19|20)\d{6}$",
}
MOST_SCALE = 6
_DIGITS = 38


@dataclass(frozen=True)
class Inferred:
    """Type of a column, and for dates the notation in which it is written."""

    name: str
    type: T.DataType
    notation: str | None = None

    def read(self) -> Column:
        """The column's values in that type."""
        text = blank_to_null(trimmed(quoted(self.name)))
        if self.notation:
            return F.try_to_date(text, self.notation)
        return text if isinstance(self.type, T.StringType) else text.try_cast(self.type)


def _state(name: str) -> list[Column]:
    c = blank_to_null(trimmed(quoted(name)))
    fits = {"long": c.rlike(LONG), "decimal": c.rlike(DECIMAL), "double": c.rlike(DOUBLE), "boolean": c.rlike(BOOLEAN)}
    fits |= {f"date {n}": c.rlike(shape) & F.try_to_date(c, n).isNotNull() for n, shape in NOTATIONS.items()}
    digits = F.regexp_extract(c, r"^[+-]?(\d*)", 1)
    behind = F.regexp_extract(c, r"\.(\d+)$", 1)
    numeric = c.rlike(DECIMAL)
    return [
        F.count(c).alias("n"),
        *[F.coalesce(F.bool_and(f), F.lit(False)).alias(kind) for kind, f in fits.items()],
        F.max(F.when(numeric, F.length(digits))).alias("before"),
        F.max(F.when(numeric, F.length(behind))).alias("behind"),
    ]


def _settled(name: str, state: dict, most_scale: int) -> Inferred:
    if state["boolean"]:
        return Inferred(name, T.BooleanType())
    for notation in NOTATIONS:  # ahead of numbers: eight digits may be a date
        if state[f"date {notation}"]:
            return Inferred(name, T.DateType(), notation)
    if state["long"]:
        return Inferred(name, T.LongType())
    if state["decimal"] and state["behind"] <= most_scale and state["before"] + state["behind"] <= _DIGITS:
        return Inferred(name, T.DecimalType(state["before"] + state["behind"], state["behind"]))
    if state["decimal"] or state["double"]:
        return Inferred(name, T.DoubleType())
    return Inferred(name, T.StringType())


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, most_scale: int = MOST_SCALE) -> list[Inferred]:
    """The narrowest type of each text column; one pass, one row on the driver.

    Numbers with more than `most_scale` digits behind the point are doubles.
    """
    names = list(columns) if columns is not None else df.columns
    if not names:
        return []
    row = df.agg(*[F.struct(*_state(c)).alias(f"c{k}") for k, c in enumerate(names)]).first()
    return [_settled(c, row[f"c{k}"].asDict(), most_scale) for k, c in enumerate(names)]


def with_inferred_types(df: DataFrame, columns: Sequence[str] | None = None, most_scale: int = MOST_SCALE) -> DataFrame:
    """The table with its text columns in their inferred types."""
    found = {i.name: i.read().alias(i.name) for i in infer_types(df, columns, most_scale)}
    return df.select(*[found.get(c, quoted(c)) for c in df.columns])


def inferred_schema(df: DataFrame, columns: Sequence[str] | None = None, most_scale: int = MOST_SCALE) -> DataFrame:
    """position, column, type, notation: one row per column."""
    rows = [(k, i.name, i.type.simpleString(), i.notation) for k, i in enumerate(infer_types(df, columns, most_scale))]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, notation string")
