"""JSON, array and text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.base import query, table, with_events
from stratiform.catalog.layers import bronze
from stratiform.catalog.mutations import payload_facts
from stratiform.functions.documents import element_array, first_element, object_path, series_document
from stratiform.functions.numeric import float_to_int, numeric_to_int, round_numeric, text_to_boolean
from stratiform.functions.text import clean_frame, truncate_message
from stratiform.functions.time import elapsed_ms, time_axis
from stratiform.operators.flatten import (
    lateral_elements,
    ordinality_join,
    with_ordinality,
    zip_longest,
    zip_shortest,
)
from stratiform.plans import explore
from stratiform.plans.silver import to_silver
from stratiform.sources.events import DOCUMENT_KEY, hourly_cells, landed_documents, read_events
from stratiform.sources.landed import hourly_frame

# The keys of a payload.
TOP_KEYS = ["latitude", "longitude", "timezone", "_m", "_k", "hourly"]
HOURLY_KEYS = [
    "time", "temperature_2m", "apparent_temperature", "relative_humidity_2m", "precipitation", "weather_code",
    "is_day", "wind_speed_10m", "uv_index", "rain", "showers", "snowfall",
]


def _words(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


@query(
    "json_path_fields",
    with_events(
        select="""SELECT record_id, latitude, longitude, 'UTC' AS timezone, n_hours,
    strftime(first_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS first_time, 'UTC' AS scalar_element FROM doc"""
    ),
)
def json_path_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw_api_response")
    return bronze(spark, sf_dir).select(
        "record_id",
        object_path(raw, "latitude").cast("double").alias("latitude"),
        object_path(raw, "longitude").cast("double").alias("longitude"),
        object_path(raw, "timezone").alias("timezone"),
        F.json_array_length(object_path(object_path(raw, "hourly"), "time")).alias("n_hours"),
        first_element(object_path(raw, "hourly", "time")).alias("first_time"),
        first_element(object_path(raw, "timezone")).alias("scalar_element"),
    )


@query("json_top_keys", f"SELECT DISTINCT unnest({_words(TOP_KEYS)}) AS top_level_keys FROM events")
def json_top_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_level_keys(bronze(spark, sf_dir))


@query("json_hourly_keys", f"SELECT DISTINCT unnest({_words(HOURLY_KEYS)}) AS hourly_level_keys FROM events")
def json_hourly_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.hourly_level_keys(bronze(spark, sf_dir))


_KINDS = {"latitude": "number", "longitude": "number", "timezone": "text", "_m": "text", "_k": "number", "hourly": "object"}


@query(
    "payload_types",
    with_events(
        select=" UNION ALL ".join(
            f"SELECT '{path}' AS path, '{kind}' AS type, count(*) AS documents FROM doc"
            for path, kind in [*_KINDS.items(), *((f"hourly.{k}", "array") for k in HOURLY_KEYS)]
        )
    ),
)
def payload_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.payload_types(bronze(spark, sf_dir))


@query(
    "raw_sample",
    with_events(
        select="""SELECT record_id, 'string' AS actual_type, n_hours,
    strftime(first_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS first_time, strftime(last_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS last_time,
    sum_rain FROM doc ORDER BY record_id LIMIT 1"""
    ),
)
def raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = explore.raw_sample(bronze(spark, sf_dir))
    return sample.select("record_id", "actual_type", *payload_facts(F.col("raw_api_response")))


@query(
    "schema_columns",
    """SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS column_name,
    unnest(['bigint', 'timestamp_ntz', 'bigint', 'string', 'double', 'string']) AS data_type,
    unnest(['long', 'timestamp_ntz', 'long', 'string', 'double', 'string']) AS udt_name,
    unnest([count(event_id), count(ts), count(user_id), count(event_type), count(value), count(props)]) AS filled
    FROM events""",
)
def schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.table_columns(table(spark, sf_dir, "events"))


_WEEK_BEFORE_LAST = "api_retrieval_time > (SELECT max(ts) FROM events) - INTERVAL 168 HOURS"


@query(
    "recent_documents",
    with_events(
        select=f"""SELECT bronze_record_id, latitude, longitude, timezone, observation_timestamp,
    {", ".join(c if c != "is_day" else "is_day <> 0 AS is_day" for c in S.METRICS.values() if c != "cloud_cover_percent")},
    api_retrieval_time
    FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, observation_timestamp
                                       ORDER BY api_retrieval_time, bronze_record_id) AS nth
          FROM flat WHERE {_WEEK_BEFORE_LAST}) WHERE nth = 1"""
    ),
)
def recent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = read_events(spark, sf_dir).agg(F.max("ts")).scalar()
    # the documents hold no cloud cover: with it, the join on ordinals would leave no hour
    variables = [v for v in S.METRICS if v != "cloud_cover"]
    rows = explore.recent_observations(bronze(spark, sf_dir), as_of, 24 * 7, variables)
    return explore.first_of_place_and_hour(rows).drop("rn")


_PAIR_SQL = """FROM (SELECT vec_id, embedding AS whole, embedding[1:label * 4 + 1] AS head FROM embeddings)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.slice("embedding", F.lit(1), F.col("label") * 4 + 1)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("whole"), head.alias("head"))


def _whole_and_head() -> dict:
    return {"whole": F.col("whole"), "head": F.col("head")}


@query(
    "array_ordinality",
    """SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS ordinal,
    CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""",
)
def array_ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return with_ordinality(vectors, [F.col("vec_id")], F.col("embedding"), "value", "ordinal")


@query(
    "json_array_ordinality",
    with_events(
        select="""SELECT bronze_record_id AS record_id, row_number() OVER (PARTITION BY bronze_record_id
        ORDER BY observation_timestamp) AS time_idx,
    strftime(observation_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS time_elem FROM flat"""
    ),
)
def json_array_ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = element_array(F.col("raw_api_response"), "hourly", "time")
    return with_ordinality(bronze(spark, sf_dir), [F.col("record_id")], times, "time_elem", "time_idx")


@query(
    "lateral_elements",
    """SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS rn,
    CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""",
)
def lateral_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateral_elements(spark, table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", "value", "rn")


@query(
    "zip_pad_longest",
    f"SELECT vec_id, CAST(unnest(whole) AS DOUBLE) AS whole, CAST(unnest(head) AS DOUBLE) AS head {_PAIR_SQL}",
)
def zip_pad_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_longest(_pairs(spark, sf_dir), [F.col("vec_id")], _whole_and_head())


_SHORTEST_SQL = f"""SELECT vec_id, ordinal, CAST(whole[ordinal] AS DOUBLE) AS whole, CAST(head[ordinal] AS DOUBLE) AS head
FROM (SELECT *, unnest(range(1, least(len(whole), len(head)) + 1)) AS ordinal {_PAIR_SQL})"""


@query("zip_trunc_shortest", _SHORTEST_SQL)
def zip_trunc_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_shortest(_pairs(spark, sf_dir), [F.col("vec_id")], _whole_and_head(), "ordinal")


@query("ordinality_join", _SHORTEST_SQL)
def ordinality_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinality_join(_pairs(spark, sf_dir), "vec_id", _whole_and_head())


@query(
    "time_axis",
    with_events(
        select="""SELECT event_type, user_id, week,
    unnest(generate_series(first_hour, last_hour, INTERVAL 1 HOUR)) AS axis_time FROM doc"""
    ),
)
def time_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds("hour")
    spans = hourly_cells(read_events(spark, sf_dir)).groupBy(*DOCUMENT_KEY).agg(
        F.min(seconds).alias("start"), (F.max(seconds) + 3600).alias("end")
    )
    axis = time_axis(F.col("start"), F.col("end"), F.lit(3600))
    return spans.select(*DOCUMENT_KEY, F.explode(axis).alias("axis_time"))


# every vector gives one series per frame variable: 50 items, each series one item further on
_STEPS = 50


@query(
    "hourly_frame",
    f"""SELECT vec_id, make_timestamp((vec_id * 3600 + (i - 1) * 1800) * 1000000) AS date_utc,
    {", ".join(f"CAST(embedding[i + {p}] AS DOUBLE) AS {name}" for p, name in enumerate(S.FRAME_VARIABLES))}
    FROM (SELECT *, unnest(range(1, {_STEPS + 1})) AS i FROM embeddings)""",
)
def hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("vec_id") * 3600
    series = [F.slice("embedding", F.lit(p + 1), F.lit(_STEPS)) for p in range(len(S.FRAME_VARIABLES))]
    return hourly_frame(
        table(spark, sf_dir, "embeddings"),
        start,
        start + _STEPS * 1800,
        F.lit(1800),
        S.FRAME_VARIABLES,
        F.array(*series),
        ["vec_id"],
    )


# variables that silver reads as numbers, with their place in the series
_READ = {p: S.METRICS[v] for p, v in enumerate(S.FRAME_VARIABLES) if v in S.METRICS and v not in S.TEXT_METRICS}


@query(
    "series_documents",
    f"""SELECT vec_id, make_timestamp((vec_id * 3600 + (i - 1) * 1800) * 1000000) AS observation_timestamp,
    {", ".join(f"CAST(embedding[i + {p}] AS DOUBLE) AS {name}" for p, name in _READ.items())}
    FROM (SELECT *, unnest(range(1, {_STEPS + 1})) AS i FROM embeddings)""",
)
def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time axis, names by position and series become a JSON document, which flattens back to rows."""
    start = F.col("vec_id") * 3600
    series = [F.slice("embedding", F.lit(p + 1), F.lit(_STEPS)).cast("array<double>") for p in range(len(S.FRAME_VARIABLES))]
    axis = time_axis(start, start + _STEPS * 1800, F.lit(1800))
    scalars = {"latitude": F.lit(1.5), "longitude": F.lit(2.5), "timezone": F.lit("UTC")}
    docs = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("record_id"),
        F.lit("vectors").alias("location_name"),
        F.timestamp_seconds(start).alias("api_retrieval_time"),
        series_document(axis, S.FRAME_VARIABLES, F.array(*series), scalars).alias("raw_api_response"),
    )
    return to_silver(docs).select(F.col("bronze_record_id").alias("vec_id"), "observation_timestamp", *_READ.values())


@query(
    "build_documents",
    with_events(
        select="""SELECT event_type, user_id, week, latitude, longitude, response_time_ms, api_retrieval_time,
    n_hours, strftime(first_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS first_time,
    strftime(last_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS last_time, sum_rain FROM doc"""
    ),
)
def built_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = F.from_json(object_path(F.col("api_response"), "hourly"), "time array<string>, rain array<double>")
    docs = landed_documents(read_events(spark, sf_dir)).withColumn("_h", hourly)
    return docs.select(
        *DOCUMENT_KEY,
        "latitude",
        "longitude",
        "response_time_ms",
        "api_retrieval_time",
        F.size("_h.time").alias("n_hours"),
        F.array_min("_h.time").alias("first_time"),
        F.element_at("_h.time", -1).alias("last_time"),
        F.aggregate("_h.rain", F.lit(0.0), lambda acc, x: acc + x).alias("sum_rain"),
    )


@query(
    "clean_nested",
    """SELECT event_id, event_type AS label, iso AS ts, [iso] AS times, value,
    event_type AS nested_label, iso AS nested_ts
    FROM (SELECT *, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS iso FROM events)""",
)
def clean_nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.encode("event_type", "UTF-8")
    nested = F.struct(label.alias("label"), F.col("ts"), F.col("value"))
    raw = read_events(spark, sf_dir).select(
        "event_id", label.alias("label"), "ts", F.array("ts").alias("times"), "value", nested.alias("nested")
    )
    return clean_frame(raw).select(
        "event_id", "label", "ts", "times", "value",
        F.col("nested.label").alias("nested_label"), F.col("nested.ts").alias("nested_ts"),
    )


@query(
    "truncate_message",
    """SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text ELSE left(text, 1000) || '...' END AS message
    FROM documents""",
)
def truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", truncate_message(F.col("text")).alias("message"))


@query(
    "numeric_rounding",
    """SELECT l_orderkey, l_linenumber,
    CAST(CAST(round(CAST(printf('%.14e', l_extendedprice * (1 - l_discount)) AS DECIMAL(38,18)), 2)
        AS DECIMAL(12,2)) AS DOUBLE) AS net,
    CAST(round_even(l_quantity * 0.5, 0) AS BIGINT) AS half_quantity,
    CAST(round(CAST(printf('%.14e', l_extendedprice) AS DECIMAL(38,18)), 0) AS BIGINT) AS whole_price,
    l_discount <> 0 AS discounted FROM lineitem""",
)
def numeric_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_numeric(price * (1 - discount), 12, 2).alias("net"),
        float_to_int(F.col("l_quantity") * 0.5).alias("half_quantity"),
        numeric_to_int(price).alias("whole_price"),
        text_to_boolean(discount.cast("string")).alias("discounted"),
    )


@query(
    "elapsed_times",
    with_events(
        select="""SELECT event_type, user_id, week,
    CAST((epoch_us(api_retrieval_time) - epoch_us(first_hour) + 5) // 10 AS DOUBLE) / 100 AS elapsed_ms
    FROM doc"""
    ),
)
def elapsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = hourly_cells(read_events(spark, sf_dir))
    spans = cells.groupBy(*DOCUMENT_KEY).agg(F.min("hour").alias("start"), F.max("m").alias("end"))
    return spans.select(*DOCUMENT_KEY, elapsed_ms(F.col("start"), F.col("end")).alias("elapsed_ms"))
