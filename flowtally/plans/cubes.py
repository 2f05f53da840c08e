"""Route matrix, busiest routes, yearly cubes by state, type and payee.

Input tables: `returnees(op_id, op_date, origin, dest, n)`, `types(op_id, op_type)`
and `ledger(op_id, year, payee, amount)`. Each cube first sums its table to the
cube's own grain; whatever follows works on that small result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import TYPE_LEVELS, operation_type
from ..functions.nulls import ascending, descending, lenient_row_sum, lenient_sum, strict_sum
from ..operators.columns import columns_first, quoted
from ..operators.joins import all_known, join_on
from ..operators.reshape import fill_columns, long_to_wide, wide_to_long
from ..operators.totals import ordered_values, top_by, with_subtotal
from ..session import staged

ALL_DESTINATIONS = "all destinations"
ALL_PAYEES = "all EU member states"
PEOPLE = "Number of deported people"
OPERATIONS = "Number of operations"


def route_matrix(returnees: DataFrame) -> DataFrame:
    """dest, origin, n over all years; NULL where a count is missing."""
    return returnees.groupBy("dest", "origin").agg(strict_sum("n").alias("n"))


def nonzero_routes(returnees: DataFrame) -> DataFrame:
    """Route matrix that skips missing counts and leaves out empty routes."""
    return returnees.groupBy("dest", "origin").agg(lenient_sum("n").alias("n")).where(F.col("n") != 0)


def _ranked_top(matrix: DataFrame, key: str, k: int) -> DataFrame:
    top = top_by(matrix, key, strict_sum("n"), k, out=f"n_{key}")
    # at most k rows reach this window
    return top.withColumn(f"rank_{key}", F.row_number().over(Window.orderBy(descending(f"n_{key}"), ascending(key))))


def ranked_top_routes(matrix: DataFrame, k: int = 15) -> DataFrame:
    """Routes between the k busiest origins and the k busiest destinations, with both ranks."""
    return matrix.join(_ranked_top(matrix, "origin", k), "origin").join(_ranked_top(matrix, "dest", k), "dest")


def top_routes(matrix: DataFrame, k: int = 15) -> DataFrame:
    """The same, in the order in which a flow chart shows its nodes."""
    return ranked_top_routes(matrix, k).orderBy("rank_origin", "rank_dest").select("dest", "origin", "n")


def yearly_returns_long(returnees: DataFrame, label: str = ALL_DESTINATIONS) -> DataFrame:
    """year, dest, origin, n with a labelled row over all destinations; empty cells left out."""
    dated = returnees.select(F.year("op_date").alias("year"), "origin", "dest", "n")
    return with_subtotal(dated, ["year", "origin", "dest"], "dest", label, ["n"]).where(F.col("n") > 0)


def yearly_returns(returnees: DataFrame, origins: Sequence[str] | None = None, label: str = ALL_DESTINATIONS) -> DataFrame:
    """One column per origin, the busiest first; rows over all destinations first.

    Without a list of origins the long cube is written once, and both the column order
    and the wide form are taken from it.
    """
    long = yearly_returns_long(returnees, label)
    if origins is None:
        long = staged(long, "yearly-returns")
        origins = ordered_values(long.where(F.col("dest") == label), "origin", lenient_sum("n"))
    wide = long_to_wide(long, ["year", "dest"], "origin", "n", origins, fill=0, unique=True)
    return wide.orderBy((F.col("dest") == label).desc(), "dest", "year")


def operations(types: DataFrame, returnees: DataFrame, null_safe: bool = True, rule=operation_type) -> DataFrame:
    """Movements with their type, full joined on the operation id alone.

    Dates differ between the two deliveries, so the types' own dates are not used.
    `rule(op_type, op_id)` names missing types.
    """
    known = types.select("op_id", "op_type")
    joined = join_on(returnees.drop("op_type"), known, "op_id", "full", null_safe)
    return joined.withColumn("op_type", rule("op_type", "op_id"))


def operation_totals(returnees: DataFrame) -> DataFrame:
    """op_id, op_date, n, known_n: movements summed per operation, for `operations`.

    Summing before the full join sends one row per operation through it. `known_n` is
    NULL where a count is missing.
    """
    return returnees.groupBy("op_id", "op_date").agg(lenient_sum("n").alias("n"), strict_sum("n").alias("known_n"))


def yearly_types_long(ops: DataFrame) -> DataFrame:
    """year, op_type, people, operations; one operation is one id on one date.

    `known_people` is NULL where a count is missing; it orders the types.
    """
    known = "known_n" if "known_n" in ops.columns else "n"
    per_operation = ops.groupBy("op_id", "op_date", "op_type").agg(
        lenient_sum("n").alias("n"), strict_sum(known).alias("known_n")
    )
    return per_operation.groupBy(F.year("op_date").alias("year"), "op_type").agg(
        lenient_sum("n").alias("people"),
        F.count(F.lit(1)).alias("operations"),
        strict_sum("known_n").alias("known_people"),
    )


def type_order(cube: DataFrame, levels: Sequence[str] = TYPE_LEVELS) -> list[str]:
    """The fixed order if it covers every type present, else types by falling total."""
    present = cube.groupBy("op_type").agg(strict_sum("known_people").alias("n"))
    if all_known(present, "op_type", levels):
        there = {r[0] for r in present.select("op_type").collect()}
        return [v for v in levels if v in there]
    return ordered_values(present, "op_type", strict_sum("n"), positive_only=False)


def yearly_types(ops: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """year, key, one column per operation type; two rows per year: people and operations."""
    cube = yearly_types_long(ops).withColumn("op_type", F.coalesce("op_type", F.lit("unknown")))
    if levels is None:
        cube = staged(cube, "yearly-types")
        levels = type_order(cube)
    measures = cube.select(
        "year",
        "op_type",
        F.col("people").cast("double").alias(PEOPLE),
        F.col("operations").cast("double").alias(OPERATIONS),
    )
    long = wide_to_long(measures, ["year", "op_type"], [PEOPLE, OPERATIONS], "key", "value")
    wide = long_to_wide(long, ["year", "key"], "op_type", "value", levels, fill=0.0)
    return wide.orderBy(ascending("year"), "key")


def paid_contributions(payments: DataFrame) -> DataFrame:
    """Older rule: payments above 0 with a known payee."""
    return payments.where(F.col("payee").isNotNull() & (F.col("amount") > 0))


def yearly_contributions_long(ledger: DataFrame) -> DataFrame:
    """year, payee, amount."""
    return ledger.groupBy("year", "payee").agg(lenient_sum("amount").alias("amount"))


def yearly_contributions(
    ledger: DataFrame, payees: Sequence[str] | None = None, label: str = ALL_PAYEES, before: str | None = None
) -> DataFrame:
    """Per year one row over all payees and one row per payee with only its own column set.

    The payee column stands before `before`, by default the first payee.
    """
    long = yearly_contributions_long(ledger)
    if payees is None:
        long = staged(long, "yearly-contributions")
        payees = ordered_values(long, "payee", lenient_sum("amount"))
        # payees whose payments sum to nothing over all years have no column
        long = long.where(F.col("payee").isin(payees))
    wide = long_to_wide(long, ["year"], "payee", "amount", payees, unique=True)
    wide = fill_columns(wide, payees, 0)
    names = F.explode(F.array(F.lit(label), *[F.lit(p) for p in payees])).alias("payee")
    rows = wide.select("year", names, *[quoted(p) for p in payees])
    own = {p: F.when(F.col("payee").isin(label, p), quoted(p)).otherwise(F.lit(0)).cast("double") for p in payees}
    out = columns_first(rows.withColumns(own), "year", "payee")
    if before is not None and before in payees:
        head = payees[: list(payees).index(before)]
        out = columns_first(out, "year", *head, "payee")
    return out


def cube_slice(cube: DataFrame, choice: Column, row: str, series: Sequence[str]) -> DataFrame:
    """Stack bounds of one slice of a cube: row, series, y0, y1, total.

    The bounds are running sums across the columns of a row, so nothing is shuffled.
    """
    total = lenient_row_sum(*[quoted(s).try_cast("double") for s in series])
    below, parts = F.lit(0.0), []
    for rank, s in enumerate(series, 1):
        above = below + F.coalesce(quoted(s).try_cast("double"), F.lit(0.0))
        parts.append(
            F.struct(F.lit(rank).alias("series_rank"), F.lit(s).alias("series"), below.alias("y0"), above.alias("y1"))
        )
        below = above
    return cube.where(choice).select(quoted(row), total.cast("double").alias("total"), F.inline(F.array(*parts)))


def axis_top(slice_: DataFrame) -> DataFrame:
    """Largest total of a slice."""
    return slice_.agg(F.max("total").alias("axis_top"))


def options(cube: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, as offered in a menu."""
    return cube.select(column).distinct().orderBy(ascending(column))
