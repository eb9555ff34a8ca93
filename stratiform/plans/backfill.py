"""Date-bounded reprocessing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.time import Bound, backfill_mode, between_bounds, date_between_bounds, utc_day


def bronze_between(bronze: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    """Bronze rows created in the inclusive range; the filter reaches the scan."""
    condition = between_bounds(F.col("created_at"), start, end)
    return bronze if condition is None else bronze.filter(condition)


def silver_between(silver: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    """Silver rows of all UTC days the range touches; prunes date partitions."""
    condition = date_between_bounds(F.col("observation_date"), start, end)
    return silver if condition is None else silver.filter(condition)


def days_between(days: list[str], start: Bound = None, end: Bound = None) -> list[str]:
    """Of ISO days those that the range touches."""
    first, last = (None if not b else utc_day(b) for b in (start, end))
    return [d for d in days if (first is None or d >= first) and (last is None or d <= last)]


def backfill_report(
    totals: DataFrame, rows_affected: int, start: Bound = None, end: Bound = None, status: str = "completed"
) -> DataFrame:
    """``totals`` is the one-row count of the target table."""
    text = [F.lit(None if not b else str(b)).cast("string") for b in (start, end)]
    return totals.select(
        F.lit(status).alias("status"),
        F.lit(rows_affected).cast("long").alias("rows_affected"),
        "total_records",
        text[0].alias("start_date"),
        text[1].alias("end_date"),
        F.lit(backfill_mode(start, end)).alias("mode"),
    )
