"""Table schemas, the variable list and the column lineage payload -> silver -> gold.

Everything in this module is a fixed value: payload keys, table and column names, types, widths.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# hourly payload key -> silver column, in the order of the silver table
METRICS = {
    "temperature_2m": "temperature_2m_celsius",
    "apparent_temperature": "apparent_temperature_celsius",
    "relative_humidity_2m": "relative_humidity_2m_percent",
    "precipitation": "precipitation_mm",
    "weather_code": "weather_code",
    "is_day": "is_day",
    "wind_speed_10m": "wind_speed_10m_kmh",
    "cloud_cover": "cloud_cover_percent",
    "uv_index": "uv_index",
    "rain": "rain_mm",
    "showers": "showers_mm",
    "snowfall": "snowfall_mm",
}
TEXT_METRICS = {"weather_code"}

# variables a typed hourly frame carries, in positional order
FRAME_VARIABLES = [
    "temperature_2m",
    "apparent_temperature",
    "relative_humidity_2m",
    "precipitation",
    "precipitation_probability",
    "weather_code",
    "wind_speed_10m",
    "wind_direction_10m",
    "surface_pressure",
    "cloud_cover",
    "rain",
    "showers",
    "snowfall",
    "uv_index",
    "is_day",
]

# table names
BRONZE_TABLE = "bronze.weather_raw"
SILVER_TABLE = "silver.weather_observations"
GOLD_TABLE = "gold.daily_weather_summary"

# column widths (characters) that a write must respect
LOCATION_WIDTH = 100
TIMEZONE_WIDTH = 50
CODE_WIDTH = 50

LANDED = T.StructType([
    T.StructField("location_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("api_retrieval_time", T.TimestampType()),
    T.StructField("response_time_ms", T.DoubleType()),
    T.StructField("api_response", T.StringType()),
])

# retrieval_date is the partition column: the unique key holds api_retrieval_time, so a load
# has to look at the partitions of its own retrieval days only
BRONZE = T.StructType([
    T.StructField("record_id", T.LongType(), False),
    T.StructField("location_name", T.StringType(), False),
    T.StructField("latitude", T.DecimalType(8, 4), False),
    T.StructField("longitude", T.DecimalType(8, 4), False),
    T.StructField("api_retrieval_time", T.TimestampType(), False),
    T.StructField("timezone", T.StringType()),
    T.StructField("response_time_ms", T.IntegerType()),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("raw_api_response", T.StringType(), False),
    T.StructField("retrieval_date", T.DateType(), False),
])
BRONZE_KEY = ["location_name", "api_retrieval_time"]

ERRORS = T.StructType([
    T.StructField("error_id", T.LongType(), False),
    T.StructField("error_timestamp", T.TimestampNTZType()),
    T.StructField("api_endpoint", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("response_status_code", T.IntegerType()),
    T.StructField("request_params", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("retry_attempt", T.IntegerType()),
    T.StructField("bronze_record_id", T.LongType()),
    T.StructField("error_date", T.DateType(), False),
])

# one row per document of a load
RESULTS = T.StructType([
    T.StructField("result_id", T.LongType(), False),
    T.StructField("success", T.BooleanType()),
    T.StructField("location", T.StringType()),
    T.StructField("response_time_ms", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("load_date", T.DateType(), False),
])
# results as they are stored: refused documents carry what the error log says of them
LOAD_LOG = T.StructType([
    *(f for f in RESULTS if f.name != "load_date"),
    *(f for f in ERRORS if f.name not in ("error_id", "response_time_ms", "error_date")),
    T.StructField("load_date", T.DateType(), False),
])

SILVER = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("location_name", T.StringType(), False),
        T.StructField("bronze_record_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("observation_timestamp", T.TimestampType(), False),
    ]
    + [
        T.StructField(column, T.StringType() if key in TEXT_METRICS else T.DoubleType())
        for key, column in METRICS.items()
    ]
    + [
        T.StructField("api_retrieval_time", T.TimestampType()),
        T.StructField("transformed_at", T.TimestampType()),
        T.StructField("observation_date", T.DateType(), False),
    ]
)
SILVER_KEY = ["location_name", "observation_timestamp"]

# columns a newer retrieval replaces; latitude, longitude, timezone and id keep their first values
SILVER_REPLACED = [*METRICS.values(), "bronze_record_id", "api_retrieval_time"]


class Measure(NamedTuple):
    column: str
    aggregate: str
    source: str
    precision: int
    scale: int = 2


MEASURES = [
    Measure("avg_temperature_2m_c", "avg", "temperature_2m_celsius", 5),
    Measure("min_temperature_2m_c", "min", "temperature_2m_celsius", 5),
    Measure("max_temperature_2m_c", "max", "temperature_2m_celsius", 5),
    Measure("avg_apparent_temp_2m_c", "avg", "apparent_temperature_celsius", 5),
    Measure("total_precipitation_mm", "sum", "precipitation_mm", 6),
    Measure("total_rain_mm", "sum", "rain_mm", 6),
    Measure("total_showers_mm", "sum", "showers_mm", 6),
    Measure("total_snowfall_mm", "sum", "snowfall_mm", 6),
    Measure("avg_humidity_percent", "avg", "relative_humidity_2m_percent", 5),
    Measure("avg_wind_speed_kmh", "avg", "wind_speed_10m_kmh", 5),
    Measure("max_wind_speed_kmh", "max", "wind_speed_10m_kmh", 5),
    Measure("avg_cloud_cover_percent", "avg", "cloud_cover_percent", 5),
    Measure("max_uv_index", "max", "uv_index", 4),
]

GOLD = T.StructType(
    [
        T.StructField("location_name", T.StringType(), False),
    ]
    + [T.StructField(m.column, T.DecimalType(m.precision, m.scale)) for m in MEASURES]
    + [
        T.StructField("daylight_hours", T.IntegerType()),
        T.StructField("dominant_weather_code", T.StringType()),
        T.StructField("record_count", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("observation_date", T.DateType(), False),
    ]
)
GOLD_KEY = ["observation_date", "location_name"]
