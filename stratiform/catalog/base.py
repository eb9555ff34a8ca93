"""Registration of queries, and the SQL view of the documents derived from ``events``.

The SQL computes everything from ``events`` directly, without JSON, so that it is an independent
check of building, parsing and flattening documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratiform import schemas as S
from stratiform.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

METRIC_LIST = ", ".join(S.METRICS.values())
MEASURE_LIST = ", ".join(m.column for m in S.MEASURES)

EVENT_SQL = """
WITH cell AS (
    SELECT event_type, user_id, date_trunc('hour', ts) AS hour,
           max(value) AS v, max(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k, max(ts) AS m
    FROM events GROUP BY event_type, user_id, date_trunc('hour', ts)
),
keyed AS (SELECT *, CAST(floor(epoch(hour) / 604800) AS BIGINT) AS week FROM cell),
doc AS (
    SELECT event_type, user_id, week, event_type AS location_name,
           (user_id * 16777216 + CAST('0x' || substr(md5(event_type), 1, 6) AS BIGINT)) * 8192 + week AS record_id,
           CAST(user_id % 180 - 89.75 AS DOUBLE) AS latitude,
           CAST(user_id % 360 - 179.5 AS DOUBLE) AS longitude,
           max(m) AS api_retrieval_time, max(k) + 0.5 AS response_time_ms,
           count(*) AS n_hours, min(hour) AS first_hour, max(hour) AS last_hour, sum(k * 0.125) AS sum_rain
    FROM keyed GROUP BY event_type, user_id, week
),
flat AS (
    SELECT d.record_id AS bronze_record_id, d.location_name, d.latitude, d.longitude, 'UTC' AS timezone,
           c.hour AS observation_timestamp,
           c.v * 0.0625 AS temperature_2m_celsius, c.v * 0.03125 AS apparent_temperature_celsius,
           c.k AS relative_humidity_2m_percent, c.k * 0.25 AS precipitation_mm,
           CAST(CAST(c.k % 10 AS DOUBLE) AS VARCHAR) AS weather_code,
           CASE WHEN hour(c.hour) BETWEEN 6 AND 17 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_day,
           c.v * 0.125 AS wind_speed_10m_kmh, CAST(NULL AS DOUBLE) AS cloud_cover_percent,
           c.k % 12 AS uv_index, c.k * 0.125 AS rain_mm, c.k * 0.125 AS showers_mm,
           CAST(0 AS DOUBLE) AS snowfall_mm, d.api_retrieval_time,
           CAST(CAST(c.hour AS DATE) AS VARCHAR) AS observation_date
    FROM keyed c JOIN doc d USING (event_type, user_id, week)
)"""


def latest_sql(name: str, source: str, where: str = "TRUE") -> str:
    """CTE: latest retrieval per location and hour."""
    return f"""{name} AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY location_name, observation_timestamp
            ORDER BY api_retrieval_time DESC, bronze_record_id DESC) AS rn
        FROM {source} WHERE {where}) WHERE rn = 1
)"""


def _rounded(measure: S.Measure) -> str:
    value = f"{measure.aggregate}({measure.source})"
    exact = f"CAST(printf('%.14e', {value}) AS DECIMAL(38,18))"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL ELSE CAST(CAST(round({exact}, 2) "
        f"AS DECIMAL({measure.precision},2)) AS DOUBLE) END AS {measure.column}"
    )


def gold_sql(name: str, source: str, where: str = "TRUE") -> str:
    """CTEs: daily summary per location; ties of the weather code go to the smallest text."""
    return f"""{name}_code AS (
    SELECT * FROM (
        SELECT observation_date, location_name, weather_code AS dominant_weather_code, row_number() OVER (
            PARTITION BY observation_date, location_name ORDER BY count(*) DESC, weather_code) AS rn
        FROM {source} WHERE {where} AND weather_code IS NOT NULL
        GROUP BY observation_date, location_name, weather_code) WHERE rn = 1
),
{name} AS (
    SELECT g.*, c.dominant_weather_code FROM (
        SELECT observation_date, location_name, {", ".join(_rounded(m) for m in S.MEASURES)},
               CAST(sum(is_day) AS BIGINT) AS daylight_hours, count(*) AS record_count
        FROM {source} WHERE {where} GROUP BY observation_date, location_name) g
    LEFT JOIN {name}_code c USING (observation_date, location_name)
)"""


def with_events(*ctes: str, select: str) -> str:
    return ",\n".join([EVENT_SQL.strip(), *ctes]) + "\n" + select


GOLD_COLUMNS = f"observation_date, location_name, {MEASURE_LIST}, daylight_hours, dominant_weather_code, record_count"
SILVER_COLUMNS = (
    "bronze_record_id, location_name, latitude, longitude, timezone, observation_timestamp, "
    f"{METRIC_LIST}, api_retrieval_time, observation_date"
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines share: no zones, decimals as doubles, wide integers, ISO days."""
    columns = []
    for f in df.schema.fields:
        name, target = f"`{f.name}`", None
        if isinstance(f.dataType, T.TimestampType):
            target = "timestamp_ntz"
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            target = "double"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            target = "bigint"
        elif isinstance(f.dataType, T.DateType):
            target = "string"
        columns.append(f"cast({name} AS {target}) AS {name}" if target else name)
    return df.selectExpr(*columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
