"""Sums, tests, conditions and sort orders with explicit NULL behaviour.

Spark's own defaults differ from what the published figures need: sums skip
NULL, comparisons with NULL are NULL, `when` treats NULL as false and ascending
sorts put NULL first. Each function here states one rule and stays a plain
column expression, so it is folded into the surrounding aggregate or projection.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(c: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum that is NULL as soon as one value of the group, or of the window, is NULL."""
    c = as_col(c)
    known, rows, total = F.count(c), F.count(F.lit(1)), F.sum(c)
    if over is not None:
        known, rows, total = known.over(over), rows.over(over), total.over(over)
    return F.when(known == rows, total)


def lenient_sum(c: Column | str) -> Column:
    """Sum that skips NULL and is 0, not NULL, for a group without any value."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def lenient_row_sum(*cols: Column | str) -> Column:
    """Sum across the columns of one row, NULL counting as 0."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(as_col(c), F.lit(0))
    return total


def matches(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """Regex test that is false, never NULL, for a NULL text: `~matches` keeps NULL rows."""
    return F.coalesce(as_col(c).rlike(("(?i)" if ignore_case else "") + pattern), F.lit(False))


def is_one_of(c: Column | str, values: Iterable) -> Column:
    """Membership that is never NULL; NULL is a member only if the list contains it."""
    values = list(values)
    known = [v for v in values if v is not None]
    return F.coalesce(as_col(c).isin(known), F.lit(len(known) < len(values)))


def strict_if(condition: Column, yes: Column, no: Column) -> Column:
    """Two-way choice that is NULL when the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; NULL where the denominator is 0 or NULL."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def half_even(c: Column, digits: int) -> Column:
    """Round with ties to the even neighbour."""
    return F.bround(c, digits)


def ascending(c: Column | str) -> Column:
    return as_col(c).asc_nulls_last()


def descending(c: Column | str) -> Column:
    return as_col(c).desc_nulls_last()
