from __future__ import annotations

import json
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratiform import schemas as S  # noqa: E402
from stratiform.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


def payload(times, latitude=1.5, longitude=2.5, timezone="UTC", **arrays) -> str:
    return json.dumps(
        {"latitude": latitude, "longitude": longitude, "timezone": timezone, "hourly": {"time": times, **arrays}}
    )


def hours(*hour: int, day: str = "2026-01-01") -> list[str]:
    return [f"{day}T{h:02d}:00:00+00:00" for h in hour]


def landed(spark, *rows):
    """rows: (location, retrieval time, payload) with optional response time."""
    schema = "location_name string, retrieved string, api_response string, response_time_ms double"
    data = [(r[0], r[1], r[2], r[3] if len(r) > 3 else 10.0) for r in rows]
    df = spark.createDataFrame(data, schema)
    return df.select(
        "location_name",
        F.lit(1.25).alias("latitude"),
        F.lit(2.5).alias("longitude"),
        F.lit("UTC").alias("timezone"),
        F.col("retrieved").cast("timestamp").alias("api_retrieval_time"),
        "response_time_ms",
        "api_response",
    )


def bronze(spark, *rows):
    """rows: (record id, location, retrieval time, payload)."""
    df = spark.createDataFrame(list(rows), "record_id long, location_name string, retrieved string, raw string")
    at = F.col("retrieved").cast("timestamp")
    return df.select(
        "record_id",
        "location_name",
        F.lit(1.25).cast("decimal(8,4)").alias("latitude"),
        F.lit(2.5).cast("decimal(8,4)").alias("longitude"),
        at.alias("api_retrieval_time"),
        F.lit("UTC").alias("timezone"),
        F.lit(10).alias("response_time_ms"),
        at.alias("created_at"),
        F.col("raw").alias("raw_api_response"),
        F.to_date(at).alias("retrieval_date"),
    )


def silver(spark, *rows):
    """rows: dicts over the silver columns; missing columns are NULL."""
    names = [f for f in S.SILVER.fields]
    df = spark.createDataFrame(
        [tuple(str(r[f.name]) if r.get(f.name) is not None else None for f in names) for r in rows],
        ", ".join(f"`{f.name}` string" for f in names),
    )
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in names])
    return df.withColumn("observation_date", F.to_date("observation_timestamp"))
