"""Data-quality checks, each one aggregate pass over its table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.documents import CORRUPT, object_path, parse_payload, text_array
from stratiform.functions.time import age, within_hours
from stratiform.plans.silver import BAD_TEXT, BAD_TIME_TEXT
from stratiform.session import moment

AsOf = Column | dt.datetime | str | None

RECENT_HOURS = 24

# inclusive ranges that physical readings stay in
RANGES = {
    "temperature_2m_celsius": (-90.0, 60.0),
    "apparent_temperature_celsius": (-100.0, 80.0),
    "relative_humidity_2m_percent": (0.0, 100.0),
    "precipitation_mm": (0.0, 500.0),
    "is_day": (0.0, 1.0),
    "wind_speed_10m_kmh": (0.0, 500.0),
    "cloud_cover_percent": (0.0, 100.0),
    "uv_index": (0.0, 20.0),
    "rain_mm": (0.0, 500.0),
    "showers_mm": (0.0, 500.0),
    "snowfall_mm": (0.0, 500.0),
}


def gate(report: DataFrame) -> DataFrame:
    """Whether a job may follow: every row of the upstream report, and at least one, says 'completed'."""
    done = F.col("status").eqNullSafe("completed")
    return report.agg(
        F.count("*").alias("reports"), F.count_if(done).alias("completed"), F.coalesce(F.min(done), F.lit(False)).alias("open")
    )


def require_completed(report: DataFrame) -> None:
    """The gate as an error."""
    if not gate(report).head().open:
        raise ValueError("the run to check has not completed")


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_records"))


def recent_count(df: DataFrame, ts_column: str, as_of: AsOf = None, hours: int = RECENT_HOURS) -> DataFrame:
    recent = within_hours(F.col(ts_column), moment(as_of), hours)
    return df.filter(recent).agg(F.count("*").alias("recent_count"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def validate_silver(silver: DataFrame, as_of: AsOf = None, hours: int = RECENT_HOURS) -> DataFrame:
    """Status, total, recent rows and NULLs among the recent rows.

    No rows is fine, a NULL observation time among recent rows is a failure, a NULL temperature
    is only reported.
    """
    recent = within_hours(F.col("transformed_at"), moment(as_of), hours)
    counted = silver.agg(
        F.count("*").alias("total_count"),
        F.count_if(recent).alias("recent_count"),
        F.count_if(recent & F.col("observation_timestamp").isNull()).alias("_times"),
        F.count_if(recent & F.col("temperature_2m_celsius").isNull()).alias("_temps"),
    )
    any_recent = F.col("recent_count") > 0
    status = (
        F.when(F.col("total_count") == 0, "success_no_data")
        .when(any_recent & (F.col("_times") > 0), "failed")
        .otherwise("success")
    )
    return counted.select(
        status.alias("status"),
        "total_count",
        "recent_count",
        F.when(any_recent, F.col("_times")).alias("null_times"),
        F.when(any_recent, F.col("_temps")).alias("null_temps"),
    )


def count_by_location(df: DataFrame) -> DataFrame:
    """Rows per location, by name. The order is of a report with one row per location."""
    return df.groupBy("location_name").agg(F.count("*").alias("records")).orderBy("location_name")


def verify_backfill(silver: DataFrame) -> DataFrame:
    """Verified status with the rows of each location."""
    return count_by_location(silver).select(F.lit("verified").alias("status"), "location_name", "records")


def health(df: DataFrame, table_name: str, ts_column: str, as_of: AsOf = None) -> DataFrame:
    """Freshness of a table: rows, latest time and its age."""
    latest = df.agg(F.count("*").alias("row_count"), F.max(ts_column).alias("latest_data"))
    data_age = age(moment(as_of), F.col("latest_data"))
    return latest.select(
        F.lit(table_name).alias("table_name"),
        "row_count",
        "latest_data",
        data_age.alias("data_age"),
        (F.unix_micros(moment(as_of)) / 1e6 - F.unix_micros(F.col("latest_data")) / 1e6).alias("data_age_seconds"),
    )


def validate_gold(gold: DataFrame) -> DataFrame:
    """Days, hours and NULLs in critical columns, per location."""
    return gold.groupBy("location_name").agg(
        F.count("*").alias("days"),
        F.sum("record_count").cast("long").alias("hours"),
        F.min("observation_date").alias("first_day"),
        F.max("observation_date").alias("last_day"),
        F.count_if(F.col("avg_temperature_2m_c").isNull()).alias("null_avg_temperature"),
        F.count_if(F.col("dominant_weather_code").isNull()).alias("null_weather_code"),
        F.count_if(F.col("record_count").isNull()).alias("null_record_count"),
    )


def range_checks(silver: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Per column: values, values below and values above its range."""
    ranges = RANGES if ranges is None else ranges
    counts = []
    for name, (low, high) in ranges.items():
        counts.append(F.count(name).alias(f"n_{name}"))
        counts.append(F.count_if(F.col(name) < low).alias(f"low_{name}"))
        counts.append(F.count_if(F.col(name) > high).alias(f"high_{name}"))
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"n_{name}").alias("checked"),
            F.col(f"low_{name}").alias("below"),
            F.col(f"high_{name}").alias("above"),
        )
        for name in ranges
    ])
    return silver.agg(*counts).select(F.inline(rows))


def type_checks(bronze: DataFrame) -> DataFrame:
    """Per payload variable: items, and items that silver refuses because they aren't of the type of
    their column; and documents in which the variable, or the whole document, is misshapen."""
    names = ["time", *S.METRICS]
    raw = F.col("raw_api_response")
    parsed = bronze.select(raw, parse_payload(raw, S.METRICS).alias("_p"))
    broken = F.col(f"_p.{CORRUPT}").isNotNull()
    # a misshapen document is read again, each variable by itself
    part = {name: F.when(broken, object_path(raw, "hourly", name)) for name in names}
    again = parsed.select(
        "_p",
        broken.alias("_broken"),
        *[F.from_json(part[name], "array<string>").alias(f"_i_{name}") for name in names],
        *[(part[name].isNotNull() & (part[name] != "null") & ~part[name].startswith("[")).alias(f"_m_{name}") for name in names],
    )
    totals = []
    for name in names:
        items = text_array(F.when(F.col("_broken"), F.when(~F.col(f"_m_{name}"), F.col(f"_i_{name}"))).otherwise(F.col(f"_p.hourly.{name}")))
        wrong = "false" if name in S.TEXT_METRICS else BAD_TIME_TEXT.format("text") if name == "time" else BAD_TEXT
        again = again.withColumn(f"_a_{name}", items)
        totals.append(F.sum(F.size(f"_a_{name}")).alias(f"n_{name}"))
        totals.append(F.sum(F.expr(f"size(filter(_a_{name}, text -> {wrong}))")).alias(f"bad_{name}"))
        totals.append(F.count_if(F.col(f"_m_{name}")).alias(f"mis_{name}"))
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("variable"),
            F.col(f"n_{name}").alias("items"),
            F.col(f"bad_{name}").alias("bad_items"),
            F.col(f"mis_{name}").alias("misshapen_documents"),
        )
        for name in names
    ])
    return again.agg(*totals).select(F.inline(rows))
