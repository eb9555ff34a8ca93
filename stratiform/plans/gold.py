"""Silver observations -> daily summary per location."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.numeric import float_to_int, round_numeric_sql
from stratiform.operators.upsert import replacing_upsert
from stratiform.session import moment


def to_gold(silver: DataFrame, as_of: Column | dt.datetime | str | None = None) -> DataFrame:
    """One row per UTC day and location, rounded half away from zero on exact decimals."""
    rows = silver.filter(F.col("observation_timestamp").isNotNull())
    raw = [F.expr(f"{m.aggregate}({m.source}) AS {m.column}") for m in S.MEASURES]
    grouped = rows.groupBy(F.to_date("observation_timestamp").alias("observation_date"), "location_name").agg(
        *raw,
        F.sum("is_day").alias("_daylight"),
        F.mode("weather_code", True).alias("dominant_weather_code"),
        F.count("*").alias("_n"),
    )
    rounded = [F.expr(f"{round_numeric_sql(m.column, m.precision, m.scale)} AS {m.column}") for m in S.MEASURES]
    return grouped.select(
        "location_name",
        *rounded,
        float_to_int(F.col("_daylight")).alias("daylight_hours"),
        "dominant_weather_code",
        F.col("_n").cast("int").alias("record_count"),
        moment(as_of).alias("created_at"),
        "observation_date",
    )


def upsert_gold(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the summaries of the aggregated days; other days stay."""
    return replacing_upsert(existing, new, S.GOLD_KEY)
