"""Equi joins in which NULL keys meet, with coalesced keys, lookups and membership.

No side is forced to be broadcast: Spark sends a side around only when its size,
estimated or measured at run time, is under spark.sql.autoBroadcastJoinThreshold,
and otherwise shuffles both sides and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col


def _condition(left: DataFrame, right: DataFrame, on: Mapping[str, str], null_safe: bool) -> Column:
    tests = [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on.items()]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    how: str = "left",
    null_safe: bool = True,
) -> DataFrame:
    """Equi join; `on` is a key, a list of shared keys or {left key: right key}.

    NULL keys match each other unless `null_safe` is off. The right keys are dropped;
    in a full join the left key takes the right one's value where it has none.
    """
    keys = _pairs(on)
    clash = [c for c in right.columns if c in left.columns and c not in keys.values()]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    inner = {b: f"__right_{i}" for i, b in enumerate(keys.values())}
    right = right.withColumnsRenamed(inner)
    joined = left.join(right, _condition(left, right, {a: inner[b] for a, b in keys.items()}, null_safe), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "right"):
        joined = joined.withColumns({a: F.coalesce(F.col(a), F.col(inner[b])) for a, b in keys.items()})
    return joined.drop(*inner.values())


def join_shared(left: DataFrame, right: DataFrame, how: str = "left", null_safe: bool = True) -> DataFrame:
    """Join on every column the two tables have in common."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return join_on(left, right, shared, how, null_safe)


def keep_members(df: DataFrame, **members: DataFrame) -> DataFrame:
    """Keep rows whose columns each occur in the one-column table given for them."""
    for column, table in members.items():
        df = join_on(df, table.select(F.col(table.columns[0]).alias(column)), column, "left_semi")
    return df


def drop_members(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Drop rows whose column occurs in a one-column exclusion table."""
    return join_on(df, table.select(F.col(table.columns[0]).alias(column)), column, "left_anti")


def all_known(df: DataFrame, column: str, known: Sequence[str]) -> bool:
    """Whether every value of a column is in a list; stops at the first that is not."""
    c = F.col(column)
    return df.where(c.isNull() | ~c.isin(list(known))).isEmpty()


def with_lookup(
    df: DataFrame, key: str, dimension: DataFrame, dim_key: str, values: Mapping[str, str], synonyms: Column | None = None
) -> DataFrame:
    """Left join of a dimension's values, {its column: new name}.

    `synonyms` rewrites the dimension's key (an expression over it) before the join.
    Names that still meet nothing get NULL.
    """
    dim = dimension.select(
        (synonyms if synonyms is not None else as_col(dim_key)).alias(key),
        *[F.col(a).alias(b) for a, b in values.items()],
    )
    return join_on(df, dim, key)
