"""Data-quality checks over derived documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.base import gold_sql, latest_sql, query, with_events
from stratiform.catalog.layers import bronze
from stratiform.catalog.mutations import faulty_bronze
from stratiform.plans import quality
from stratiform.plans.gold import to_gold
from stratiform.plans.silver import silver_candidates
from stratiform.sources.events import read_events

LATEST = latest_sql("latest", "flat")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_candidates(bronze(spark, sf_dir))
    return rows.withColumn("transformed_at", F.col("api_retrieval_time"))


def _now(spark: SparkSession, sf_dir: str) -> Column:
    return read_events(spark, sf_dir).agg(F.max("ts")).scalar()


RECENT = "api_retrieval_time > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS"


@query(
    "validate_silver",
    with_events(
        LATEST,
        select=f"""SELECT 'success' AS status, count(*) AS total_count, count(*) FILTER ({RECENT}) AS recent_count,
    CAST(0 AS BIGINT) AS null_times,
    count(*) FILTER ({RECENT} AND temperature_2m_celsius IS NULL) AS null_temps FROM latest""",
    ),
)
def validate_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_silver(_silver(spark, sf_dir), _now(spark, sf_dir))


@query("recent_count", with_events(LATEST, select=f"SELECT count(*) AS recent_count FROM latest WHERE {RECENT}"))
def recent_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.recent_count(_silver(spark, sf_dir), "transformed_at", _now(spark, sf_dir))


@query(
    "null_counts",
    with_events(
        LATEST,
        select="""SELECT count(*) FILTER (observation_timestamp IS NULL) AS null_observation_timestamp,
    count(*) FILTER (temperature_2m_celsius IS NULL) AS null_temperature_2m_celsius,
    count(*) FILTER (cloud_cover_percent IS NULL) AS null_cloud_cover_percent FROM latest""",
    ),
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["observation_timestamp", "temperature_2m_celsius", "cloud_cover_percent"]
    return quality.null_counts(_silver(spark, sf_dir), columns)


_BY_LOCATION = "SELECT location_name, count(*) AS records FROM latest GROUP BY location_name"


@query("count_by_location", with_events(LATEST, select=_BY_LOCATION + " ORDER BY location_name"))
def count_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_by_location(_silver(spark, sf_dir))


@query(
    "backfill_verify",
    with_events(LATEST, select=f"SELECT 'verified' AS status, location_name, records FROM ({_BY_LOCATION})"),
)
def backfill_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verify_backfill(_silver(spark, sf_dir))


@query(
    "backfill_gate",
    with_events(
        LATEST,
        select=f"""SELECT what, count(*) AS reports, count(*) FILTER (status = 'completed') AS completed,
    min(status = 'completed') AS open FROM (SELECT 'all done' AS what, 'completed' AS status FROM ({_BY_LOCATION})
    UNION ALL SELECT 'one short', CASE WHEN records = (SELECT max(records) FROM ({_BY_LOCATION})) THEN 'failed'
    ELSE 'completed' END FROM ({_BY_LOCATION})) GROUP BY what""",
    ),
)
def backfill_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate between jobs over a report for each location, with and without an unfinished one."""
    counts = quality.count_by_location(_silver(spark, sf_dir))
    most = counts.agg(F.max("records")).scalar()
    status = {
        "all done": F.lit("completed"),
        "one short": F.when(F.col("records") == most, "failed").otherwise("completed"),
    }
    gates = [quality.gate(counts.select(c.alias("status"))).withColumn("what", F.lit(what)) for what, c in status.items()]
    return gates[0].unionByName(gates[1])


@query(
    "health_check",
    with_events(
        select=f"""SELECT '{S.BRONZE_TABLE}' AS table_name, count(*) AS row_count,
    max(api_retrieval_time) AS latest_data,
    epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(max(api_retrieval_time)) AS data_age_seconds,
    epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(api_retrieval_time)) AS data_age_micros FROM doc"""
    ),
)
def health_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.health(bronze(spark, sf_dir), S.BRONZE_TABLE, "created_at", "2024-02-01T00:00:00")
    micros = """((extract(DAY FROM data_age) * 24L + extract(HOUR FROM data_age)) * 60 + extract(MINUTE FROM data_age))
        * 60000000 + cast(extract(SECOND FROM data_age) * 1000000 AS long)"""
    return found.withColumn("data_age_micros", F.expr(micros)).drop("data_age")


@query(
    "gold_validate",
    with_events(
        LATEST,
        gold_sql("gold", "latest"),
        select="""SELECT location_name, count(*) AS days, CAST(sum(record_count) AS BIGINT) AS hours,
    min(observation_date) AS first_day, max(observation_date) AS last_day,
    count(*) FILTER (avg_temperature_2m_c IS NULL) AS null_avg_temperature,
    count(*) FILTER (dominant_weather_code IS NULL) AS null_weather_code, CAST(0 AS BIGINT) AS null_record_count
    FROM gold GROUP BY location_name""",
    ),
)
def gold_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_gold(to_gold(_silver(spark, sf_dir)))


@query(
    "range_checks",
    with_events(
        LATEST,
        select=" UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, count({name}) AS checked, count(*) FILTER ({name} < {low}) AS below,
    count(*) FILTER ({name} > {high}) AS above FROM latest"""
            for name, (low, high) in quality.RANGES.items()
        ),
    ),
)
def range_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_checks(_silver(spark, sf_dir))


def _items(name: str) -> str:
    n = "n_hours"
    if name == "cloud_cover":
        n = "0"
    elif name == "temperature_2m":
        n = "n_hours + CASE WHEN fault = 5 THEN 1 ELSE 0 END"
    elif name == "rain":
        n = "CASE WHEN fault = 6 THEN 0 ELSE n_hours END"
    elif name == "snowfall":
        n = "CASE WHEN fault = 7 THEN 1 ELSE n_hours END"
    elif name == "uv_index":
        n = "CASE WHEN fault = 8 THEN 0 ELSE n_hours END"
    bad = "CASE WHEN fault = 7 THEN 1 ELSE 0 END" if name == "snowfall" else "0"
    misshapen = "CASE WHEN fault = 8 THEN 1 ELSE 0 END" if name == "uv_index" else "0"
    totals = [("items", n), ("bad_items", bad), ("misshapen_documents", misshapen)]
    return f"SELECT '{name}' AS variable, " + ", ".join(f"CAST(sum({x}) AS BIGINT) AS {c}" for c, x in totals) + " FROM f"


@query(
    "type_checks",
    with_events(
        """f AS (
    SELECT n_hours, minute(api_retrieval_time) AS fault,
           unnest(CASE WHEN minute(api_retrieval_time) = 10 THEN [0, 1] ELSE [0] END) AS copy
    FROM doc WHERE minute(api_retrieval_time) NOT IN (0, 1, 2, 3, 4, 9)
)""",
        select=" UNION ALL ".join(_items(name) for name in ["time", *S.METRICS]),
    ),
)
def type_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.type_checks(faulty_bronze(spark, sf_dir))
