"""Group totals, subtotal and grand-total rows, partition totals, top-k and value ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import ascending, descending, lenient_sum
from .columns import numeric_columns, quoted
from .joins import join_on


def sum_numeric(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Lenient sum of every numeric column that is no key."""
    names = [c for c in numeric_columns(df) if c not in keys]
    return df.groupBy(*keys).agg(*[lenient_sum(quoted(c)).alias(c) for c in names])


def with_subtotal(df: DataFrame, keys: Sequence[str], over: str, label: str, sums: Sequence[str]) -> DataFrame:
    """Group sums by `keys`, plus the sums over all values of `over`, labelled.

    The fine level is aggregated first; the grouping sets expand only its result.
    """
    fine = df.groupBy(*keys).agg(*[lenient_sum(c).alias(c) for c in sums])
    coarse = [k for k in keys if k != over]
    both = fine.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in coarse]], *[F.col(k) for k in keys])
    out = both.agg(F.grouping(over).alias("__total"), *[F.sum(c).alias(c) for c in sums])
    named = F.when(F.col("__total") == 1, F.lit(label)).otherwise(F.col(over))
    return out.withColumn(over, named).drop("__total")


def with_grand_total(df: DataFrame, key: str, label: str) -> DataFrame:
    """Sum every numeric column by `key` and append one labelled row over all keys."""
    fine = sum_numeric(df, key)
    names = numeric_columns(fine)
    both = fine.rollup(key).agg(F.grouping(key).alias("__total"), *[F.sum(quoted(c)).alias(c) for c in names])
    named = F.when(F.col("__total") == 1, F.lit(label)).otherwise(F.col(key))
    return both.withColumn(key, named).drop("__total")


def with_group_total(df: DataFrame, by: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Put group aggregates, {new column: aggregate}, on each row.

    Aggregated first, with partial sums ahead of the shuffle, and joined back, so that no
    group has to fit into one task; a window would gather it there.
    """
    sums = df.groupBy(*[quoted(b) for b in by]).agg(*[agg.alias(out) for out, agg in totals.items()])
    return join_on(df, sums, by)


def single_rows(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that are alone in their group.

    Counted with a partial aggregate, so a huge group never meets in one task: only
    groups of one row are kept, and for those any value is the value.
    """
    rest = [c for c in df.columns if c not in by]
    sized = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__size"), *[F.first(c).alias(c) for c in rest])
    return sized.where(F.col("__size") == 1).select(*df.columns)


def top_by(df: DataFrame, key: str, metric: Column, k: int, out: str = "total") -> DataFrame:
    """The k values of `key` with the largest aggregate; equal ones by name."""
    totals = df.groupBy(key).agg(metric.alias(out))
    return totals.orderBy(descending(out), ascending(key)).limit(k)


def ordered_values(df: DataFrame, key: str, metric: Column, positive_only: bool = True, most: int = 5000) -> list:
    """Values of `key` by falling aggregate, as a list for column orders.

    For keys that become columns; more than `most` of them is an error. The long forms of
    the cubes do without columns and so without this bound.
    """
    sums = df.groupBy(key).agg(metric.alias("__total"))
    if positive_only:
        sums = sums.where(F.col("__total") > 0)
    rows = sums.orderBy(descending("__total"), ascending(key)).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"too many values of {key} for columns")
    return [r[0] for r in rows]


def ranked_values(df: DataFrame, column: str, levels: Sequence[str], out: str) -> DataFrame:
    """Rank of a value in a fixed list, from 1; unlisted values have none."""
    return df.withColumn(out, F.when(F.col(column).isin(list(levels)), F.array_position(F.lit(list(levels)), F.col(column)).cast("int")))
