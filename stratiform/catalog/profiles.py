"""Profiles that merge between loads, checked against exact answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.base import query, with_events
from stratiform.catalog.mutations import DELIVERIES_SQL, LANDED_SQL, arriving_silver, stored_silver
from stratiform.catalog.checks import LATEST, _silver
from stratiform.plans import sketches
from stratiform.session import scratch_dir
from stratiform.sources.events import faulty_documents, read_events

RANKS = [0.01, 0.25, 0.5, 0.75, 0.99]
PROFILED = ["temperature_2m_celsius", "relative_humidity_2m_percent", "precipitation_mm", "wind_speed_10m_kmh", "cloud_cover_percent", "uv_index"]


@query(
    "range_profile",
    with_events(
        LATEST,
        select="SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({r} AS DOUBLE) AS rank, count({c}) AS values, true AS within FROM latest" for c in PROFILED for r in RANKS)
        + ") WHERE values > 0",
    ),
)
def range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of each variable from the merged sketches of two loads, held against their exact ranks."""
    rows = _silver(spark, sf_dir).withColumn("load", F.minute("api_retrieval_time") < 30)
    path = scratch_dir(spark, "values")
    sketches.value_sketches(rows, ["load"], PROFILED).write.parquet(path)
    merged = sketches.merged_sketches(spark.read.parquet(path))
    found = sketches.quantiles(merged, RANKS).collect()  # a row for each variable and rank
    counts, each = [], []
    for k, r in enumerate(found):
        counts += [F.count_if(F.col(r.variable) < r.value).alias(f"b{k}"), F.count_if(F.col(r.variable) <= r.value).alias(f"u{k}")]
        least, most = (r.rank + e * sketches.RANK_ERROR for e in (-1, 1))
        within = (F.col(f"b{k}") <= most * r["values"]) & (F.col(f"u{k}") >= least * r["values"])
        each.append(F.struct(F.lit(r.variable).alias("variable"), F.lit(r.rank).alias("rank"), F.lit(r["values"]).alias("values"), within.alias("within")))
    return rows.agg(*counts).select(F.inline(F.array(*each)))


_TOP = {"latitude": ("number", "n"), "hourly": ("object", "n - f0"), "hourly_units": ("object", "f0")}
_TOP |= {name: (kind, "whole") for name, kind in {"longitude": "number", "timezone": "string", "_m": "string", "_k": "number"}.items()}
_ARRAYS = {
    "time": "'array<string>'",
    "rain": "CASE WHEN whole > f6 THEN 'array<number>' ELSE 'array<nothing>' END",
    "snowfall": "CASE WHEN f7 = 0 THEN 'array<number>' WHEN f7 = whole THEN 'array<string>' ELSE 'array<variant>' END",
    "uv_index": "CASE WHEN f8 = 0 THEN 'array<number>' WHEN f8 = whole THEN 'number' ELSE 'variant' END",
}
_PLAIN = ["temperature_2m", "apparent_temperature", "relative_humidity_2m", "precipitation", "weather_code", "is_day", "wind_speed_10m", "showers"]
_PATHS = [f"SELECT '{p}' AS path, '{kind}' AS type, {n} AS documents, n - ({n}) AS missing FROM tally" for p, (kind, n) in _TOP.items()]
_PATHS += [
    f"SELECT 'hourly.{p}', {kind}, whole, n - whole FROM tally" for p, kind in (_ARRAYS | dict.fromkeys(_PLAIN, "'array<number>'")).items()
]


@query(
    "payload_schema",
    with_events(
        LANDED_SQL,
        """tally AS (
    SELECT count(*) AS n, count(*) FILTER (fault = 0) AS f0, count(*) FILTER (fault = 6) AS f6, count(*) FILTER (fault = 7) AS f7,
           count(*) FILTER (fault = 8) AS f8, count(*) FILTER (fault NOT IN (0, 1)) AS whole
    FROM landed WHERE fault NOT IN (2, 3)
)""",
        select="SELECT * FROM (" + " UNION ALL ".join(_PATHS) + ") WHERE documents > 0",
    ),
)
def payload_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined type of every path over all documents, from the merged states of two loads."""
    docs = faulty_documents(read_events(spark, sf_dir)).withColumn("load", F.minute("api_retrieval_time") < 30)
    path = scratch_dir(spark, "kinds")
    sketches.payload_kinds(docs, "api_response", ["load"]).write.parquet(path)
    return sketches.payload_types(sketches.merged_kinds(spark.read.parquet(path)))


@query(
    "delivery_overlap",
    with_events(
        *DELIVERIES_SQL,
        select="""SELECT observation_date, stored, arriving, common,
        CASE WHEN stored = 0 THEN 'new' WHEN common = 0 THEN 'append' ELSE 'merge' END AS action
    FROM (SELECT n.observation_date, count(*) AS arriving, count(o.location_name) AS common,
                 (SELECT count(*) FROM old h WHERE h.observation_date = n.observation_date) AS stored
          FROM new n LEFT JOIN old o ON o.location_name = n.location_name AND o.observation_timestamp = n.observation_timestamp
          GROUP BY n.observation_date)""",
    ),
)
def delivery_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: hours stored, hours arriving and those in both, from sketches that were kept when each was written."""
    kept = []
    for rows in (stored_silver(spark, sf_dir), arriving_silver(spark, sf_dir)):
        path = scratch_dir(spark, "keys")
        sketches.key_sketches(rows, S.SILVER_KEY, ["observation_date"]).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return sketches.overlap(*kept, ["observation_date"])
