"""The older export: slot rows of the yearly sheets and the later tidy returns in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_on
from ..operators.reshape import union_by_name

COLUMNS = ["op_id", "op_date", "op_type", "origin", "dest", "n"]


def sheet_movements(operations: DataFrame, destinations: DataFrame) -> DataFrame:
    """Slot rows with the state, date, type and id of their sheet line (`deliveries.sheet_*`)."""
    heads = operations.select("row_id", F.col("id").alias("op_id"), "op_date", "op_type", "origin")
    return join_on(destinations.select("row_id", "dest", "n"), heads, "row_id", null_safe=False).select(*COLUMNS)


def combined_movements(operations: DataFrame, destinations: DataFrame, returns: DataFrame) -> DataFrame:
    """Sheets above `deliveries.tidy_returns`; the cubes take it from here."""
    return union_by_name(sheet_movements(operations, destinations), returns.select(*COLUMNS))
