"""Hourly documents derived from an ``events`` table.

A document is one user's week of one event type: ``event_type`` plays the location, the document
holds one item per hour with events. A week bounds a document to 168 items however many events
there are, because events are reduced to hours first. All factors are powers of two, so any
engine computes identical doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.documents import build_documents
from stratiform.functions.numeric import numeric_to_int, round_numeric

WEEK_SECONDS = 604_800
DOCUMENT_KEY = ["event_type", "user_id", "week"]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times carry no zone and mean UTC."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_cells(events: DataFrame) -> DataFrame:
    """Per event type, user and hour: highest value, highest k, latest event."""
    k = F.from_json("props", "k int")["k"]
    hour = F.date_trunc("hour", "ts")
    cells = events.groupBy("event_type", "user_id", hour.alias("hour")).agg(
        F.max("value").alias("v"), F.max(k).cast("double").alias("k"), F.max("ts").alias("m")
    )
    week = F.floor(F.unix_seconds("hour") / WEEK_SECONDS)
    return cells.withColumn("week", week)


def _variables() -> dict[str, Column]:
    v, k = F.col("v"), F.col("k")
    hour = F.hour("hour")
    return {
        "temperature_2m": v * 0.0625,
        "apparent_temperature": v * 0.03125,
        "relative_humidity_2m": k,
        "precipitation": k * 0.25,
        "weather_code": k % 10,
        "is_day": F.when(hour.between(6, 17), 1.0).otherwise(0.0),
        "wind_speed_10m": v * 0.125,
        "uv_index": k % 12,
        "rain": k * 0.125,
        "showers": k * 0.125,
        "snowfall": F.lit(0.0),
    }


def landed_documents(events: DataFrame) -> DataFrame:
    """One landed document per event type, user and week, with its key columns."""
    scalars = {
        "latitude": F.col("user_id") % 180 - F.lit(89.75),
        "longitude": F.col("user_id") % 360 - F.lit(179.5),
        "timezone": F.lit("UTC"),
        "_m": F.max("m"),
        "_k": F.max("k"),
    }
    docs = build_documents(hourly_cells(events), DOCUMENT_KEY, "hour", _variables(), scalars)
    return docs.select(
        *DOCUMENT_KEY,
        F.col("event_type").alias("location_name"),
        "latitude",
        "longitude",
        "timezone",
        F.col("_m").alias("api_retrieval_time"),
        (F.col("_k") + 0.5).alias("response_time_ms"),
        "api_response",
    )


def record_id() -> Column:
    """A number per document that needs no sort: user, type and week side by side."""
    kind = F.conv(F.substring(F.md5("event_type"), 1, 6), 16, 10).cast("long")
    return (F.col("user_id") * 16_777_216 + kind) * 8192 + F.col("week")


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows of all documents; they count as created when they were retrieved."""
    return landed_documents(events).select(
        record_id().alias("record_id"),
        "location_name",
        round_numeric(F.col("latitude"), 8, 4).alias("latitude"),
        round_numeric(F.col("longitude"), 8, 4).alias("longitude"),
        "api_retrieval_time",
        "timezone",
        numeric_to_int(F.col("response_time_ms")).alias("response_time_ms"),
        F.col("api_retrieval_time").alias("created_at"),
        F.col("api_response").alias("raw_api_response"),
        F.to_date("api_retrieval_time").alias("retrieval_date"),
    )


def first_delivery() -> Column:
    """Splits documents into two deliveries by the half of the hour they were retrieved in."""
    return F.minute("api_retrieval_time") < 30


def faulty_documents(events: DataFrame) -> DataFrame:
    """All landed documents, some damaged; the minute of retrieval decides which and how."""
    docs = landed_documents(events)
    minute = F.minute("api_retrieval_time")
    body = F.col("api_response")
    damaged = (
        F.when(minute == 0, F.concat(F.lit('{"latitude":0.5,"hourly_units":'), body, F.lit("}")))
        .when(minute == 1, F.lit('{"latitude":0.5,"hourly":{}}'))
        .when(minute == 2, F.lit(None).cast("string"))
        .when(minute == 3, F.regexp_replace(body, '"snowfall":\\[', '"snowfall":[NaN,'))
        .when(minute == 5, F.regexp_replace(body, '"temperature_2m":\\[', '"temperature_2m":[1.5,'))
        .when(minute == 6, F.regexp_replace(body, '"rain":\\[[^\\]]*\\]', '"rain":[]'))
        .when(minute == 7, F.regexp_replace(body, '"snowfall":\\[[^\\]]*\\]', '"snowfall":["none"]'))
        .when(minute == 8, F.regexp_replace(body, '"uv_index":\\[[^\\]]*\\]', '"uv_index":7'))
        .otherwise(body)
    )
    copies = F.explode(F.when(minute == 10, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return docs.select(
        *DOCUMENT_KEY,
        F.when(minute != 4, F.col("location_name")).alias("location_name"),
        F.when(minute == 9, 10000.0).otherwise(F.col("latitude")).alias("latitude"),
        "longitude",
        "timezone",
        "api_retrieval_time",
        "response_time_ms",
        damaged.alias("api_response"),
        copies.alias("copy"),
    ).withColumn("response_time_ms", F.col("response_time_ms") + F.col("copy") * 1000)


def landed_columns(df: DataFrame) -> DataFrame:
    return df.select(*S.LANDED.names)
