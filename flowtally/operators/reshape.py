"""Long and wide forms, grids, diagonals and repeated column groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col
from .columns import quoted
from .joins import join_on


def long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    value: str,
    values: Sequence,
    fill=None,
    unique: bool = False,
    other: str | None = None,
) -> DataFrame:
    """One row per key, one column per listed value of `column`.

    Two rows for the same cell are an error, raised by the plan itself. `unique`
    leaves that test out where a preceding aggregate already rules it out.
    The value list is explicit, so no job has to look for it. A value outside the list,
    NULL included, is an error too; with `other`, the sum of such cells goes to a column of
    that name.
    """
    if not unique:
        one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"more than one row for a cell of {column}"))).otherwise(
            F.first(value)
        )
        df = df.groupBy(*keys, column).agg(one.alias(value))
    is_listed = F.coalesce(quoted(column).isin(list(values)), F.lit(False)) if values else F.lit(False)
    if other is None:
        unlisted = F.raise_error(F.concat(F.lit(f"value of {column} without a column: "), quoted(column).cast("string")))
        message = F.raise_error(F.lit(f"NULL in {column} has no column"))
        kind = df.schema[column].dataType
        checked = F.when(is_listed, quoted(column)).when(quoted(column).isNull(), message.cast(kind)).otherwise(unlisted.cast(kind))
        df = df.withColumn(column, checked)
    else:
        df = df.withColumn("__other", F.when(~is_listed, quoted(value)))
        rest = df.groupBy(*keys).agg(F.sum("__other").alias(other))
        listed = df.where(is_listed).groupBy(*keys).pivot(column, list(values)).agg(F.first(value))
        wide = join_on(rest, listed, list(keys))
        wide = wide.select(*keys, *[quoted(str(v)) for v in values], quoted(other))
        return wide if fill is None else fill_columns(wide, [*[str(v) for v in values], other], fill)
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(F.first(value))
    return wide if fill is None else fill_columns(wide, [str(v) for v in values], fill)


def fill_columns(df: DataFrame, names: Sequence[str], fill) -> DataFrame:
    """Replace NULL in the named columns."""
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(fill)) for c in names})


def wide_to_long(df: DataFrame, keys: Sequence[str], names: Sequence[str], column: str, value: str) -> DataFrame:
    """One row per key and named column; NULL values stay."""
    return df.unpivot([quoted(k) for k in keys], [quoted(c) for c in names], column, value)


def densify(df: DataFrame, keys: Sequence[str], axis: str, values: Sequence, value: str, fill=0) -> DataFrame:
    """Give every existing key a row for each axis value, filling the missing ones.

    Done as wide-and-back over an explicit axis list: one aggregate, no pairing of tables.
    """
    wide = long_to_wide(df, keys, axis, value, values, fill, unique=True)
    long = wide_to_long(wide, keys, [str(v) for v in values], axis, value)
    return long.withColumn(axis, F.col(axis).cast(df.schema[axis].dataType))


def diagonal(df: DataFrame, column: str, value: str, values: Sequence[str], fill=0) -> DataFrame:
    """Keep each row and add one column per listed value, set only where it is the row's own."""
    own = {v: F.when(as_col(column) == v, as_col(value)).otherwise(F.lit(fill)) for v in values}
    return df.withColumns(own).drop(value)


def slots_to_rows(df: DataFrame, keys: Sequence[str], slots: Mapping[str, Sequence[str]], slot: str = "slot") -> DataFrame:
    """Repeated column groups to rows: `{new column: [its column in slot 1, 2, …]}`.

    One generate per input row and no shuffle. Slots without any value are left out.
    """
    width = {len(cols) for cols in slots.values()}
    if len(width) != 1:
        raise ValueError("every column group needs the same number of slots")
    groups = F.array(
        *[
            F.struct(F.lit(i + 1).alias(slot), *[quoted(cols[i]).alias(out) for out, cols in slots.items()])
            for i in range(width.pop())
        ]
    )
    rows = df.select(*[quoted(k) for k in keys], F.inline(groups))
    return rows.dropna(how="all", subset=list(slots))


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Stack tables of differing columns; missing ones are NULL."""
    out, *rest = tables
    for t in rest:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
