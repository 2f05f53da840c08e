"""One job that writes every published cube under its published name and columns.

Each run adds a version (see `sources.snapshots`): readers see all cubes of a run or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import rename
from ..session import partitions_for, staged, staging
from ..sources import snapshots
from . import costs as C
from . import cubes as Q

# File names and column names of the published tables.
ROUTES = "N_RETURNEES_MSNAME_DEST_new"
TOP_ROUTES = "N_RETURNEES_MSNAME_DEST_ROUTES_MIN_15_new"
YEARLY_RETURNS = "N_RETURNEES_YEARS_MSNAME_new"
YEARLY_TYPES = "OPTYPE_YEAR_new"
YEARLY_CONTRIBUTIONS = "FX_CONTRIB_YEARS_MSNAME_new"
PER_PERSON = "CONTRIB_PP_BY_DEST_new"
AVERAGES = "average_per_year"
AVERAGES_BY_DESTINATION = "average_per_year_dest"
LEFT_OUT = "averages_omitted"

ROUTE_NAMES = {"dest": "DEST", "origin": "MSNAME", "n": "N_RETURNEES"}
PER_PERSON_NAMES = {
    "dest": "DEST", "n": "N_RETURNEES", "amount": "EUR", "n_ops": "N_OPS", "per_person": "FX_CONTRIB_PP", "iso": "iso",
}


def published(
    returnees: DataFrame, types: DataFrame, ledger: DataFrame, countries: DataFrame, null_safe: bool = True
) -> dict[str, DataFrame]:
    """Name -> cube. Where no id is NULL, plain keys (`null_safe` off) spare shuffles.

    Movements, ledger and operation costs feed several cubes, so each is written once
    to the staging folder and read from there. What works per operation shuffles the movements
    once, by operation and into partitions by their number: the counts by destination and the joins that
    follow find their rows in place, and no task takes more as run-time coalescing would have it.
    """
    returnees = staged(returnees, "returnees")
    ledger = staged(ledger, "ledger")
    by_operation = returnees.repartition(partitions_for(returnees), "op_id")
    costs = staged(C.operation_costs(by_operation, ledger, null_safe=null_safe), "operation-costs")
    matrix = staged(Q.route_matrix(returnees), "routes")
    ops = Q.operations(types, Q.operation_totals(by_operation), null_safe)
    ranking = C.cost_per_person(costs, countries).withColumn("amount", F.col("amount").cast("double"))
    return {
        ROUTES: rename(matrix.orderBy("dest", "origin"), ROUTE_NAMES),
        TOP_ROUTES: rename(Q.top_routes(matrix), ROUTE_NAMES),
        YEARLY_RETURNS: rename(Q.yearly_returns(returnees), {"year": "YEAR", "dest": "DEST"}),
        YEARLY_TYPES: rename(Q.yearly_types(ops), {"year": "YEAR", "key": "KEY"}),
        YEARLY_CONTRIBUTIONS: rename(Q.yearly_contributions(ledger), {"year": "YEAR", "payee": "MSNAME"}),
        PER_PERSON: rename(ranking.select(*PER_PERSON_NAMES), PER_PERSON_NAMES),
        AVERAGES: C.average_by_year(costs),
        AVERAGES_BY_DESTINATION: C.average_by_year_and_destination(costs),
        LEFT_OUT: C.share_left_out(by_operation),
    }


def publish(
    returnees: DataFrame,
    types: DataFrame,
    ledger: DataFrame,
    countries: DataFrame,
    folder: str,
    form: str = "parquet",
    null_safe: bool = True,
) -> dict[str, str]:
    """Write all cubes below a folder as its next version; name -> path. Copies staged on the way are removed.

    `snapshots.read_table` reads a cube of the current version, or of an earlier one.
    """
    spark = returnees.sparkSession
    with staging(spark):
        done = snapshots.publish_tables(spark, folder, published(returnees, types, ledger, countries, null_safe), form)
    return {name: f"{folder}/{entry['folder']}" for name, entry in done.tables.items()}


def export(spark: SparkSession, folder: str, target: str) -> dict[str, str]:
    """Each cube of the current version as one CSV file `<target>/<name>.csv`, as charts read them; name -> path."""
    names = snapshots.manifest(spark, folder).tables
    return {name: snapshots.export_file(spark, folder, name, f"{target}/{name}.csv") for name in names}
