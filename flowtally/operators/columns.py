"""Choosing, renaming, ordering and mapping columns. All of these are pure projections."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import lenient_row_sum


def quoted(name: str) -> Column:
    """Column by its literal name, also when that holds dots, blanks or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by {old: new}; a name that is not there is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {missing}")
    return df.withColumnsRenamed(dict(names))


def rename_at(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Rename by position, counted from 1."""
    return df.toDF(*[names.get(i, c) for i, c in enumerate(df.columns, 1)])


def select_at(df: DataFrame, *positions: int) -> DataFrame:
    """Keep columns by position (from 1), or drop those given as negative positions."""
    if all(p < 0 for p in positions):
        return df.select(*[quoted(c) for i, c in enumerate(df.columns, 1) if -i not in positions])
    return df.select(*[quoted(df.columns[p - 1]) for p in positions])


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from one column to another, both included."""
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i : j + 1]


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def map_columns(df: DataFrame, names: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: change(quoted(c)) for c in names})


def columns_first(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[quoted(c) for c in (*names, *[c for c in df.columns if c not in names])])


def move_before(df: DataFrame, name: str, anchor: str) -> DataFrame:
    """Put one column directly before another."""
    rest = [c for c in df.columns if c != name]
    i = rest.index(anchor)
    return df.select(*[quoted(c) for c in (*rest[:i], name, *rest[i:])])


def add_row_sum(df: DataFrame, out: str, names: Sequence[str]) -> DataFrame:
    """Sum of several columns per row, NULL as 0."""
    return df.withColumn(out, lenient_row_sum(*[quoted(c) for c in names]))
