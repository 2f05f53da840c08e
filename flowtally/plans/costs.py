"""Costs of single-destination operations, per person, by destination and by year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import year_of_text
from ..functions.names import RANKING_RELABELS, RANKING_SYNONYMS
from ..functions.nulls import ascending, descending, half_even, lenient_sum, ratio, strict_sum
from ..functions.text import apply_rules, replace_patterns
from ..operators.joins import join_on, with_lookup
from ..operators.totals import single_rows, with_grand_total

AVERAGE = "average"


def operation_costs(returnees: DataFrame, ledger: DataFrame, floor: float = 10, null_safe: bool = True) -> DataFrame:
    """op_id, dest, op_date, n, amount, n_ops for operations with exactly one destination.

    The ledger is summed per operation before it is joined, by id only: an id used on
    two dates carries its full cost twice. Operations without a cost, or with fewer
    people than `floor`, are left out.
    """
    per_place = returnees.groupBy("op_id", "dest", "op_date").agg(lenient_sum("n").alias("n"))
    single = single_rows(per_place, ["op_id", "op_date"])
    costs = ledger.groupBy("op_id").agg(lenient_sum("amount").alias("amount"))
    return (
        join_on(single, costs, "op_id", "left", null_safe)
        .where(F.col("amount").isNotNull() & (F.col("n") >= floor))
        .select("op_id", "dest", "op_date", "n", "amount", F.lit(1).cast("long").alias("n_ops"))
    )


def operation_costs_by_record(records: DataFrame, payments: DataFrame, key: str = "op_id", null_safe: bool = True) -> DataFrame:
    """Older rule: operations that appear in exactly one record, with all their payment rows.

    A record counts its people once for every payment row, so `n` is multiplied by their
    number, `payments`; that gives the sums of a row-by-row join without its fan-out, and
    an operation with very many payments is summed before the join. Missing payments are
    0, records without a destination are left out, and there is no floor per operation.
    """
    single = single_rows(records.select(key, "dest", "n"), [key]).where(F.col("dest").isNotNull())
    paid = payments.groupBy(key).agg(lenient_sum("amount").alias("amount"), F.count(F.lit(1)).alias("payments"))
    joined = join_on(single, paid, key, "left", null_safe)
    times = F.coalesce("payments", F.lit(1))
    return joined.withColumns({"n": F.col("n") * times, "amount": F.coalesce("amount", F.lit(0)), "payments": times})


def cost_per_person(
    costs: DataFrame,
    countries: DataFrame,
    k: int = 26,
    floor: float = 10,
    label: str = AVERAGE,
    label_iso: str | None = None,
    synonyms: Mapping[str, str] = RANKING_SYNONYMS,
) -> DataFrame:
    """dest, n, amount, …, per_person, iso: the k dearest destinations, the average among them.

    The row over all destinations competes like any other and keeps a NULL code
    unless `label_iso` is given.
    """
    ranked = (
        with_grand_total(costs.drop("op_id", "op_date", "payments"), "dest", label)
        .withColumn("per_person", ratio("amount", "n"))
        .withColumn("dest", apply_rules("dest", [], RANKING_RELABELS))
        .where(F.col("n") >= floor)
    )
    named = with_lookup(ranked, "dest", countries, "name", {"iso": "iso"}, replace_patterns("name", synonyms))
    iso = F.when(F.col("dest") == label, F.lit(label_iso).cast("string")).otherwise(F.col("iso"))
    return named.withColumn("iso", iso).orderBy(descending("per_person"), ascending("dest")).limit(k)


def average_by_year(costs: DataFrame) -> DataFrame:
    """year, eur_total, number_returned, avg_eur_per_person."""
    return _averages(costs, "year").orderBy(ascending("year"))


def average_by_year_and_destination(costs: DataFrame) -> DataFrame:
    named = costs.withColumnRenamed("dest", "destination")
    return _averages(named, "year", "destination").orderBy(ascending("destination"), ascending("year"))


def _averages(costs: DataFrame, *keys: str) -> DataFrame:
    dated = costs.withColumn("year", year_of_text("op_date"))
    sums = dated.groupBy(*keys).agg(strict_sum("amount").alias("eur_total"), strict_sum("n").alias("number_returned"))
    average = half_even(ratio("eur_total", "number_returned"), 2)
    return sums.select(
        *keys, F.col("eur_total").cast("double").alias("eur_total"), "number_returned", average.alias("avg_eur_per_person")
    )


def share_left_out(returnees: DataFrame, exactly: int | None = 2) -> DataFrame:
    """year, doubles, total, not_counted: operation x destination rows left out of the averages.

    Counts rows of operations with exactly two destinations; with `exactly=None` those
    of all operations with more than one.
    """
    per_place = returnees.groupBy("op_id", "dest", "op_date").agg(F.lit(1).alias("one"))
    sizes = per_place.groupBy("op_id", "op_date").agg(F.count(F.lit(1)).alias("n_dest"))
    counted = F.col("n_dest") > 1 if exactly is None else F.col("n_dest") == exactly
    years = sizes.groupBy(year_of_text("op_date").alias("year")).agg(
        lenient_sum(F.when(counted, F.col("n_dest"))).cast("long").alias("doubles"),
        F.sum("n_dest").alias("total"),
    )
    return years.withColumn("not_counted", half_even(ratio("doubles", "total"), 2)).orderBy(ascending("year"))
