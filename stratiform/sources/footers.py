"""Counts and extremes answered from Parquet footers.

Read through Spark's second data source interface, count, min and max of a whole table are pushed into the scan, which
then opens footers only. Footers keep no order for timestamps, so a table that is to be asked has the
microseconds of its time beside it, as a whole number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

V1_SOURCES, PUSHDOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def micros_of(column: str) -> str:
    return f"{column}_us"


def with_micros(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(micros_of(column), F.unix_micros(column))


def footer_rows(spark: SparkSession, path: str, schema: T.StructType, columns: list[str]) -> DataFrame:
    """The numbers of ``columns`` of the Parquet files at ``path``, for aggregates that footers can answer."""
    spark.conf.set(PUSHDOWN, "true")  # it concerns only such reads
    held = spark.conf.get(V1_SOURCES)
    spark.conf.set(V1_SOURCES, ",".join(s for s in held.split(",") if s != "parquet"))  # a read is bound when it is made
    try:
        return spark.read.schema(schema).parquet(path).select(*columns)
    finally:
        spark.conf.set(V1_SOURCES, held)


def footer_health(spark: SparkSession, path: str, schema: T.StructType, column: str) -> DataFrame:
    """(row_count, latest) of a table written ``with_micros``; no row of it is read."""
    rows = footer_rows(spark, path, schema, [micros_of(column)])
    found = rows.agg(F.count("*").alias("row_count"), F.max(micros_of(column)).alias("_us"))
    return found.select("row_count", F.timestamp_micros("_us").alias("latest_data"))
