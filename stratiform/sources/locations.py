"""The location dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The tracked places (name, latitude, longitude, zone), the variables requested
# for each of them, and the variables used when a request names none.
LOCATIONS = [
    ("Bangkok", 13.754, 100.5014, "Asia/Bangkok"),
    ("Tokyo", 35.6762, 139.6503, "Asia/Tokyo"),
    ("Paris", 48.8534, 2.3488, "Europe/Paris"),
]
HOURLY_VARIABLES = [
    "temperature_2m",
    "apparent_temperature",
    "relative_humidity_2m",
    "precipitation",
    "precipitation_probability",
    "weather_code",
    "wind_speed_10m",
    "wind_direction_10m",
    "uv_index",
    "is_day",
    "rain",
    "showers",
    "snowfall",
]
DEFAULT_VARIABLES = ["temperature_2m"]
DEFAULT_TIMEZONE = "GMT"
DEFAULT_FORECAST_DAYS = 7


def with_variables(places: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """Attach the requested variables to every location."""
    names = F.array(*[F.lit(v) for v in (HOURLY_VARIABLES if variables is None else variables)])
    return places.withColumn("hourly_variables", names.cast("array<string>"))


def locations(spark: SparkSession) -> DataFrame:
    """The built-in locations."""
    schema = "location_name string, latitude double, longitude double, timezone string"
    return with_variables(spark.createDataFrame(LOCATIONS, schema))


def variables_or_default(variables: Column) -> Column:
    """A missing or empty variable list requests the temperature only."""
    default = F.array(*[F.lit(v) for v in DEFAULT_VARIABLES])
    return F.when(F.size(variables) > 0, variables).otherwise(default)


def request_params(
    latitude: Column, longitude: Column, timezone: Column, variables: Column | None = None, days: Column | None = None
) -> Column:
    """The parameters of a request as JSON text; NULL when nothing is known of the request."""
    fields = F.struct(
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        F.coalesce(timezone, F.lit(DEFAULT_TIMEZONE)).alias("timezone"),
        variables_or_default(F.array().cast("array<string>") if variables is None else variables).alias("hourly"),
        (F.lit(DEFAULT_FORECAST_DAYS) if days is None else F.coalesce(days, F.lit(DEFAULT_FORECAST_DAYS))).alias(
            "forecast_days"
        ),
    )
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.to_json(fields))
