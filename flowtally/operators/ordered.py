"""Fill-down, row numbers and running sums in row order, without one task per large group.

A plain window over a file or a key puts that group into one task, however large it is.
Here all rows are cut into chunks of about equal size along (group, row order), whatever
the sizes of groups and the gaps between positions:

1. a sample of rows, one for each of a fixed number of hash buckets, gives the edges of the
   chunks; rows are written once (`session.staged`), each with the number of its chunk, which
   follows from its own values alone, so nothing is shuffled yet;
2. only a group at the edge of a chunk can run into the next one, so there are at most two
   such groups per chunk; for these, a partial aggregate gives one small row per chunk, and
   a window over those rows the value carried into the next;
3. one window runs over each group within its chunk, the only shuffle of all rows, and the
   carried value is added.

There is one path for every group size. Sums of doubles are taken in decimals of 12 places,
so results do not depend on where chunks end. The last order column must be unique inside
its group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .columns import quoted
from .joins import join_on

EXACT = "decimal(38,12)"
_PER_CHUNK = 20  # sampled rows


@dataclass(frozen=True)
class Scan:
    """What to compute in row order: in a window frame, once per chunk, and from carried and own value."""

    framed: Callable[[Column], Column]
    per_chunk: Callable[[Column, Column], Column]
    added: Callable[[Column, Column], Column]
    exact: bool = False


LAST_VALUE = Scan(
    framed=lambda c: F.last(c, ignorenulls=True),
    per_chunk=lambda c, position: F.max_by(c, F.when(c.isNotNull(), position)),
    added=lambda carried, own: F.coalesce(own, carried),
)
TOTAL = Scan(
    framed=F.sum,
    per_chunk=lambda c, position: F.sum(c),
    added=lambda carried, own: F.coalesce(carried + own, carried, own),
    exact=True,
)


def _edges(df: DataFrame, keys: Sequence[str], chunks: int) -> list:
    """Upper ends of all chunks but the last, in ascending order: at most `chunks` - 1 rows."""
    key = F.struct(*[quoted(k) for k in keys])
    hashed = [F.hash(quoted(k)) for k in keys]  # of any type; NULL is one value
    bucket = F.pmod(F.xxhash64(*hashed), F.lit(chunks * _PER_CHUNK))
    picked = df.groupBy(bucket.alias("bucket")).agg(F.min_by(key, F.xxhash64(F.lit(1), *hashed)).alias("key"))
    rows = picked.agg(F.sort_array(F.collect_list("key")).alias("keys")).first()["keys"]  # a few for each chunk
    at = dict.fromkeys(len(rows) * k // chunks for k in range(1, chunks))
    return [rows[k] for k in at if 0 < k < len(rows)]


def _numbered(df: DataFrame, keys: Sequence[str], edges: Sequence, out: str) -> DataFrame:
    """Rows with `out`: how many edges lie at or below them, found by halving.

    A column for each step: compiled like any other, where a lambda would be interpreted row by row.
    """
    if not edges:
        return df.withColumn(out, F.lit(0))
    types = [df.schema[k].dataType for k in keys]
    listed = F.array(*[F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(e, types, keys)]) for e in edges])
    at, row = F.col(out), F.col("__row")
    placed = df.withColumns({"__row": F.struct(*[quoted(k) for k in keys]), out: F.lit(0)})
    for step in [1 << k for k in reversed(range(len(edges).bit_length()))]:
        reached = (at + step <= len(edges)) & (F.get(listed, at + step - 1) <= row)
        placed = placed.withColumn(out, F.when(reached, at + step).otherwise(at))
    return placed.drop("__row")


def chunked(df: DataFrame, keys: Sequence[str], out: str = "__chunk", chunks: int | None = None) -> DataFrame:
    """Rows with the number of their chunk, in the order of `keys`; written once."""
    parts = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = _edges(df, keys, parts) if parts > 1 else []
    return staged(_numbered(df, keys, edges, out), "ordered-rows")


def _carried(placed: DataFrame, scans: Mapping[str, tuple[str, Scan]], order: Sequence[str], by: Sequence[str]) -> DataFrame:
    """by, __chunk and `__from_<output>`: what earlier chunks of a group hand to this one."""
    ends = placed
    if by:
        group = F.struct(*[quoted(b) for b in by])
        edges = placed.groupBy("__chunk").agg(F.min(group).alias("low"), F.max(group).alias("high"))
        edges = edges.select(F.explode(F.array("low", "high")).alias("edge")).select("edge.*").distinct()
        ends = join_on(placed, edges, by, "left_semi")
    position = F.struct(*[quoted(o) for o in order])
    ends = ends.groupBy(*[quoted(b) for b in by], "__chunk").agg(
        *[s.per_chunk(quoted(f"__in_{out}"), position).alias(f"__end_{out}") for out, (_, s) in scans.items()]
    )
    # a group has at most one row per chunk here
    above = Window.partitionBy(*[quoted(b) for b in by]).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(
        *[quoted(b) for b in by],
        "__chunk",
        *[s.framed(quoted(f"__end_{out}")).over(above).alias(f"__from_{out}") for out, (_, s) in scans.items()],
    )


def scan_rows(
    df: DataFrame,
    outputs: Mapping[str, tuple[str, Scan]],
    order: Sequence[str],
    by: Sequence[str] = (),
    chunks: int | None = None,
    before: bool = False,
) -> DataFrame:
    """Add `{new column: (column, scan)}`, each computed over the rows so far.

    `before` leaves the current row out. `order` and `by` may be of any sortable type.
    `chunks` is by default the number of shuffle partitions; it has no effect on results.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    double = {out: s.exact and kinds[c] in ("double", "float") for out, (c, s) in outputs.items()}
    inputs = {f"__in_{out}": quoted(c).cast(EXACT) if double[out] else quoted(c) for out, (c, _) in outputs.items()}
    placed = chunked(df.withColumns(inputs), [*by, *order], chunks=chunks)

    last_row = -1 if before else Window.currentRow
    so_far = (
        Window.partitionBy(*[quoted(b) for b in by], "__chunk")
        .orderBy(*[quoted(o) for o in order])
        .rowsBetween(Window.unboundedPreceding, last_row)
    )
    scanned = placed.withColumns({f"__own_{out}": s.framed(quoted(f"__in_{out}")).over(so_far) for out, (_, s) in outputs.items()})
    joined = join_on(scanned, _carried(placed, outputs, order, by), [*by, "__chunk"])
    columns = {c: quoted(c) for c in df.columns}
    for out, (_, s) in outputs.items():
        value = s.added(quoted(f"__from_{out}"), quoted(f"__own_{out}"))
        columns[out] = value.cast("double") if double[out] else value
    return joined.select(*[c.alias(name) for name, c in columns.items()])


def fill_down(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = (), chunks: int | None = None
) -> DataFrame:
    """Each NULL takes the nearest value above it; leading NULLs stay."""
    return scan_rows(df, {c: (c, LAST_VALUE) for c in columns}, order, by, chunks)


def number_rows(df: DataFrame, out: str, order: Sequence[str], by: Sequence[str] = (), chunks: int | None = None) -> DataFrame:
    """Row number from 1 in row order, within each group of `by`."""
    one = df.withColumn("__one", F.lit(1).cast("long"))
    return scan_rows(one, {out: ("__one", TOTAL)}, order, by, chunks).drop("__one")


def running_total(
    df: DataFrame,
    columns: Mapping[str, str],
    order: Sequence[str],
    by: Sequence[str] = (),
    before: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Running sums {new column: column}; with `before`, the sum of the rows above, 0 at the top."""
    out = scan_rows(df, {o: (c, TOTAL) for o, c in columns.items()}, order, by, chunks, before)
    return out.withColumns({o: F.coalesce(quoted(o), F.lit(0)) for o in columns}) if before else out
