"""Cubes that take in a delivery, replace one or give one back, without the others' rows.

A delivery is summed once to the cube's own grain. Its state holds for every cell the number
of rows and, for every measure, the sum and the number of its known values; sums of doubles
are exact decimals, so a state can be taken out again and leaves nothing behind. States of
deliveries are published beside the cubes (`sources.snapshots`): the next version lists the
files of unchanged deliveries again and adds those of the new one, and the cubes follow from
all states. Work grows with the new delivery and the cells, not with all rows.

A strict sum is NULL where a cell has a value that is not known, a lenient one skips such
values; both follow from the same state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import quoted
from ..operators.ordered import EXACT
from ..session import staged, staging
from ..sources import snapshots

STATE = "state of "
ROWS = "rows"
Cube = Callable[[DataFrame], DataFrame]


def state_of(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """keys, rows, and `<measure> sum` and `<measure> known` of every cell."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    value = {m: quoted(m).cast(EXACT) if kinds[m] in ("double", "float") else quoted(m) for m in measures}
    sums = [c for m in measures for c in (F.sum(value[m]).alias(f"{m} sum"), F.count(quoted(m)).alias(f"{m} known"))]
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def merged(states: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One state from several, for all keys or for some of them."""
    parts = [ROWS, *[f"{m} {part}" for m in measures for part in ("sum", "known")]]
    kinds = {f.name: f.dataType for f in states.schema.fields}
    return states.groupBy(*[quoted(k) for k in keys]).agg(*[F.sum(quoted(p)).cast(kinds[p]).alias(p) for p in parts])


def cube_of(
    states: DataFrame, keys: Sequence[str], strict: Mapping[str, str] | None = None, lenient: Mapping[str, str] | None = None, as_type: str = "double"
) -> DataFrame:
    """keys and sums, {new column: measure}, by the strict and the lenient rule."""
    strict, lenient = strict or {}, lenient or {}
    whole = merged(states, keys, list(dict.fromkeys([*strict.values(), *lenient.values()])))
    total = lambda m: quoted(f"{m} sum").cast(as_type)
    return whole.select(
        *[quoted(k) for k in keys],
        *[F.when(quoted(f"{m} known") == F.col(ROWS), total(m)).alias(out) for out, m in strict.items()],
        *[F.coalesce(total(m), F.lit(0).cast(as_type)).alias(out) for out, m in lenient.items()],
    )


def _published(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Entries of the states that the current version lists."""
    if not snapshots.versions(spark, folder):
        return {}
    return {name: e for name, e in snapshots.manifest(spark, folder).tables.items() if name.startswith(STATE)}


def deliveries(spark: SparkSession, folder: str) -> list[str]:
    """Deliveries in the current version."""
    return sorted(name.removeprefix(STATE) for name in _published(spark, folder))


def _states(spark: SparkSession, folder: str, names: Sequence[str], new: DataFrame | None) -> DataFrame:
    old = snapshots.read_tables(spark, folder, list(names)) if names else None
    if old is None or new is None:
        return new if old is None else old
    return old.unionByName(new)


def add_delivery(
    spark: SparkSession,
    folder: str,
    delivery: str,
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    cubes: Mapping[str, Cube],
) -> snapshots.Manifest:
    """Publish the version that holds this delivery, in place of an earlier one of its name.

    `cubes` turn the states of all deliveries into tables, see `cube_of`.
    """
    kept = {name: e for name, e in _published(spark, folder).items() if name != f"{STATE}{delivery}"}
    with staging(spark):
        state = staged(state_of(df, keys, measures), "delivery-state")
        states = _states(spark, folder, list(kept), state)
        tables = {f"{STATE}{delivery}": state, **{name: cube(states) for name, cube in cubes.items()}}
        return snapshots.publish_tables(spark, folder, tables, carried=kept)


def remove_delivery(spark: SparkSession, folder: str, delivery: str, cubes: Mapping[str, Cube]) -> snapshots.Manifest:
    """Publish the version without a delivery."""
    known = _published(spark, folder)
    if f"{STATE}{delivery}" not in known:
        raise KeyError(f"no delivery {delivery} below {folder}")
    kept = {name: e for name, e in known.items() if name != f"{STATE}{delivery}"}
    states = _states(spark, folder, list(kept), None) if kept else snapshots.read_table(spark, folder, f"{STATE}{delivery}").limit(0)
    return snapshots.publish_tables(spark, folder, {name: cube(states) for name, cube in cubes.items()}, carried=kept)
