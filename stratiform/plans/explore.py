"""Looking into stored documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.documents import object_keys, object_path, parse_payload, text_array
from stratiform.functions.numeric import text_to_boolean
from stratiform.functions.time import within_hours
from stratiform.operators.dedup import first_per_key
from stratiform.operators.flatten import zip_shortest
from stratiform.session import moment


def hourly_objects(bronze: DataFrame) -> DataFrame:
    """The hourly part of every document as JSON text."""
    return bronze.select("record_id", object_path(F.col("raw_api_response"), "hourly").alias("hourly"))


def raw_sample(bronze: DataFrame, n: int = 1) -> DataFrame:
    """The first stored documents with the type of the payload column."""
    picked = bronze.orderBy("record_id").limit(n)
    return picked.select("record_id", F.typeof("raw_api_response").alias("actual_type"), "raw_api_response")


def payload_types(bronze: DataFrame) -> DataFrame:
    """For each path of the payloads, what kinds of values stand there and in how many documents."""
    document = F.parse_json("raw_api_response")
    members = F.explode(F.try_variant_get(document, F.lit("$"), "map<string,variant>"))
    top = bronze.select(members.alias("path", "value"))
    hourly = F.explode(F.try_variant_get(document, F.lit("$.hourly"), "map<string,variant>"))
    inner = bronze.select(hourly.alias("name", "value")).select(F.concat(F.lit("hourly."), "name").alias("path"), "value")
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    name = (
        F.when(kind.isin("DECIMAL", "BIGINT", "DOUBLE", "FLOAT"), "number")
        .when(kind == "STRING", "text")
        .when(kind == "VOID", "null")
        .otherwise(F.lower(kind))
    )
    return top.unionByName(inner).groupBy("path", name.alias("type")).agg(F.count("*").alias("documents"))


def top_level_keys(bronze: DataFrame) -> DataFrame:
    return bronze.select(F.explode(object_keys(F.col("raw_api_response"))).alias("top_level_keys")).distinct()


def hourly_level_keys(bronze: DataFrame) -> DataFrame:
    keys = object_keys(F.col("raw_api_response"), "hourly")
    return bronze.select(F.explode(keys).alias("hourly_level_keys")).distinct()


def table_columns(df: DataFrame) -> DataFrame:
    """Column name, type and rows with a value, for every column of a table."""
    fields = df.schema.fields
    filled = df.agg(*[F.count(f"`{f.name}`").alias(f"_{i}") for i, f in enumerate(fields)])
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.dataType.typeName()).alias("udt_name"),
            F.col(f"_{i}").alias("filled"),
        )
        for i, f in enumerate(fields)
    ])
    return filled.select(F.inline(rows))


def recent_observations(
    bronze: DataFrame,
    as_of: Column | dt.datetime | str | None = None,
    hours: int = 1,
    variables: list[str] | None = None,
) -> DataFrame:
    """Hours of recently created documents, joined on their ordinal: an hour counts only where
    every variable has an item. Documents are filtered before they are parsed."""
    variables = list(S.METRICS) if variables is None else variables
    recent = bronze.filter(within_hours(F.col("created_at"), moment(as_of), hours))
    parsed = recent.select(
        "record_id", "created_at", parse_payload(F.col("raw_api_response"), variables).alias("_p")
    )
    keep = [
        F.col("record_id").alias("bronze_record_id"),
        F.col("_p.latitude").cast("double").alias("latitude"),
        F.col("_p.longitude").cast("double").alias("longitude"),
        F.col("_p.timezone").alias("timezone"),
        F.col("created_at").alias("api_retrieval_time"),
    ]
    arrays = {name: text_array(F.col(f"_p.hourly.{name}")) for name in ("time", *variables)}
    rows = zip_shortest(parsed, keep, arrays, "rn")
    columns = []
    for key in variables:
        column = S.METRICS[key]
        if key in S.TEXT_METRICS:
            columns.append(F.col(key).alias(column))
        elif key == "is_day":
            columns.append(text_to_boolean(F.col(key)).alias(column))
        else:
            columns.append(F.col(key).cast("double").alias(column))
    kept = ["bronze_record_id", "latitude", "longitude", "timezone"]
    return rows.select(
        *kept, F.col("time").cast("timestamp").alias("observation_timestamp"), *columns, "api_retrieval_time", "rn"
    )


def first_of_place_and_hour(rows: DataFrame) -> DataFrame:
    """Keep the first row per coordinates and hour, as an insert that skips conflicts would."""
    key = ["latitude", "longitude", "observation_timestamp"]
    return first_per_key(rows, key, [F.col("api_retrieval_time"), F.col("bronze_record_id")])
