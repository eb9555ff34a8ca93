"""Loads and upserts. The first delivery is stored, the second one arrives."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.base import (
    GOLD_COLUMNS,
    SILVER_COLUMNS,
    gold_sql,
    latest_sql,
    query,
    with_events,
)
from stratiform.catalog.layers import bronze
from stratiform.functions.documents import object_path
from stratiform.operators.upsert import ACTION, conditional_upsert, insert_or_ignore
from stratiform.plans import bronze as bronze_plan
from stratiform.plans.gold import to_gold, upsert_gold
from stratiform.plans.silver import silver_candidates, silver_rejects
from stratiform.plans.warehouse import Warehouse
from stratiform.session import scratch_dir
from stratiform.sources.events import (
    bronze_from_events,
    faulty_documents,
    first_delivery,
    landed_columns,
    landed_documents,
    read_events,
    record_id,
)
from stratiform.sources.locations import with_variables

AS_OF = "2024-02-01T00:00:00"
FIRST, SECOND = "minute(api_retrieval_time) < 30", "minute(api_retrieval_time) >= 30"
# a delivery that leaves whole days alone: late documents of every other week
LATE = "minute(api_retrieval_time) >= 30 AND CAST(floor(epoch(observation_timestamp) / 604800) AS BIGINT) % 2 = 1"

UPSERT_SQL = f"""upserted AS (
    SELECT CASE WHEN o.location_name IS NULL OR n.api_retrieval_time > o.api_retrieval_time
                THEN n.bronze_record_id ELSE o.bronze_record_id END AS bronze_record_id,
           coalesce(o.location_name, n.location_name) AS location_name,
           CASE WHEN o.location_name IS NULL THEN n.latitude ELSE o.latitude END AS latitude,
           CASE WHEN o.location_name IS NULL THEN n.longitude ELSE o.longitude END AS longitude,
           coalesce(o.timezone, n.timezone) AS timezone,
           coalesce(o.observation_timestamp, n.observation_timestamp) AS observation_timestamp,
           {", ".join(
               f"CASE WHEN o.location_name IS NULL OR n.api_retrieval_time > o.api_retrieval_time "
               f"THEN n.{c} ELSE o.{c} END AS {c}" for c in S.METRICS.values()
           )},
           greatest(o.api_retrieval_time, n.api_retrieval_time) AS api_retrieval_time,
           coalesce(o.observation_date, n.observation_date) AS observation_date,
           CASE WHEN o.location_name IS NULL THEN 'insert'
                WHEN n.api_retrieval_time > o.api_retrieval_time THEN 'update' ELSE 'keep' END AS action
    FROM old o FULL OUTER JOIN new n
      ON o.location_name = n.location_name AND o.observation_timestamp = n.observation_timestamp
)"""
DELIVERIES_SQL = (latest_sql("old", "flat", FIRST), latest_sql("new", "flat", SECOND))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_candidates(bronze(spark, sf_dir).filter(first_delivery()))
    return rows.select(
        F.col("bronze_record_id").alias("id"), *rows.columns, F.col("api_retrieval_time").alias("transformed_at")
    ).select(*S.SILVER.names)


def arriving_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_candidates(bronze(spark, sf_dir).filter(~first_delivery()))


def upserted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditional_upsert(stored_silver(spark, sf_dir), arriving_silver(spark, sf_dir), AS_OF)


@query(
    "silver_upsert", with_events(*DELIVERIES_SQL, UPSERT_SQL, select=f"SELECT {SILVER_COLUMNS}, action FROM upserted")
)
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserted_silver(spark, sf_dir).withColumnRenamed(ACTION, "action").drop("id", "transformed_at")


@query(
    "silver_insert_ignore",
    with_events(
        *DELIVERIES_SQL,
        select=f"""SELECT {SILVER_COLUMNS} FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o
        WHERE o.location_name = n.location_name AND o.observation_timestamp = n.observation_timestamp)""",
    ),
)
def silver_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, arriving = stored_silver(spark, sf_dir), arriving_silver(spark, sf_dir)
    return insert_or_ignore(stored, arriving, S.SILVER_KEY, [F.desc("api_retrieval_time")])


@query(
    "gold_upsert",
    with_events(
        latest_sql("old", "flat", f"NOT ({LATE})"),
        latest_sql("new", "flat", LATE),
        UPSERT_SQL,
        gold_sql("old_gold", "old"),
        gold_sql("new_gold", "upserted", "observation_date IN (SELECT observation_date FROM new)"),
        select=f"""SELECT {GOLD_COLUMNS}, CASE WHEN EXISTS (SELECT 1 FROM old_gold o
        WHERE o.observation_date = n.observation_date AND o.location_name = n.location_name)
        THEN 'update' ELSE 'insert' END AS action FROM new_gold n
    UNION ALL SELECT {GOLD_COLUMNS}, 'keep' AS action FROM old_gold o WHERE NOT EXISTS (SELECT 1 FROM new_gold n
        WHERE o.observation_date = n.observation_date AND o.location_name = n.location_name)""",
    ),
)
def gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the delivery are aggregated anew, whole; all other days stay."""
    docs = landed_documents(read_events(spark, sf_dir))
    late = (F.minute("api_retrieval_time") >= 30) & (F.col("week") % 2 == 1)
    stored, arriving = (silver_candidates(_bronze_columns(docs.filter(c))) for c in (~late, late))
    held = stored.select(F.col("bronze_record_id").alias("id"), "*", F.col("api_retrieval_time").alias("transformed_at"))
    upserted = conditional_upsert(held, arriving, AS_OF)
    touched = upserted.join(arriving.select("observation_date").distinct(), "observation_date", "left_semi")
    merged = upsert_gold(to_gold(held, AS_OF), to_gold(touched, AS_OF))
    return merged.withColumnRenamed(ACTION, "action").drop("created_at")


def _bronze_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        record_id().alias("record_id"), "location_name", "api_retrieval_time", F.col("api_response").alias("raw_api_response")
    )


# documents with faults, as SQL: the minute of retrieval decides; minute 10 lands twice
LANDED_SQL = """landed AS (
    SELECT * REPLACE (
        CASE WHEN fault <> 4 THEN location_name END AS location_name,
        CASE WHEN fault = 9 THEN 10000.0::DOUBLE ELSE latitude END AS latitude,
        response_time_ms + copy * 1000 AS response_time_ms)
    FROM (SELECT *, minute(api_retrieval_time) AS fault,
                 unnest(CASE WHEN minute(api_retrieval_time) = 10 THEN [0, 1] ELSE [0] END) AS copy FROM doc)
),
checked AS (
    SELECT *, CASE fault WHEN 0 THEN 'ValueError' WHEN 1 THEN 'ValueError' WHEN 2 THEN 'ValueError'
                  WHEN 3 THEN 'JSONDecodeError' WHEN 4 THEN 'NotNullViolation'
                  WHEN 9 THEN 'NumericValueOutOfRange' END AS error_type,
              CASE fault WHEN 0 THEN 'Missing ''hourly'' data in API response'
                  WHEN 1 THEN '''hourly'' data is empty in API response'
                  WHEN 2 THEN 'API returned empty response' WHEN 3 THEN 'invalid input syntax for type json'
                  WHEN 4 THEN 'null value in column "location_name" violates not-null constraint'
                  WHEN 9 THEN 'numeric field overflow' END AS error_message
    FROM landed
),
stored AS (SELECT location_name, api_retrieval_time FROM doc WHERE second(api_retrieval_time) < 6),
verdict AS (
    SELECT * EXCLUDE (error_type, error_message),
           CASE WHEN error_type IS NOT NULL THEN error_type WHEN taken OR nth > 1 THEN 'UniqueViolation' END
               AS error_type,
           CASE WHEN error_type IS NOT NULL THEN error_message WHEN taken OR nth > 1
               THEN 'duplicate key value violates unique constraint "unique_location_request"' END AS error_message
    FROM (SELECT c.*, EXISTS (SELECT 1 FROM stored s WHERE s.location_name = c.location_name
                                AND s.api_retrieval_time = c.api_retrieval_time) AS taken,
                 row_number() OVER (PARTITION BY c.location_name, c.api_retrieval_time, c.error_type IS NULL
                                    ORDER BY c.response_time_ms) AS nth FROM checked c)
)"""

# what the stored text says: hours, first and last one, and a sum
PAYLOAD_SELECT = """n_hours, strftime(first_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS first_time,
    strftime(last_hour, '%Y-%m-%dT%H:%M:%S+00:00') AS last_time"""
BRONZE_SELECT = f"""{PAYLOAD_SELECT}, CASE WHEN fault = 6 THEN 0.0 ELSE sum_rain END AS sum_rain, location_name, latitude, longitude, api_retrieval_time, 'UTC' AS timezone,
    CAST(floor(response_time_ms + 0.5) AS BIGINT) AS response_time_ms, TIMESTAMP '2024-02-01 00:00:00' AS created_at,
    CAST(CAST(api_retrieval_time AS DATE) AS VARCHAR) AS retrieval_date"""
ERROR_SELECT = """TIMESTAMP '2024-02-01 00:00:00' AS error_timestamp, 'api' AS api_endpoint, error_type, error_message,
    CAST(NULL AS BIGINT) AS response_status_code, CASE WHEN location_name IS NOT NULL THEN
        '{"latitude":' || latitude || ',"longitude":' || longitude || ',"timezone":"UTC","hourly":["' ||
        array_to_string((SELECT list(variable ORDER BY ordinal) FROM variables), '","') || '"],"forecast_days":7}'
        END AS request_params,
    latitude, longitude, 2::BIGINT AS retry_attempt, '2024-02-01' AS error_date"""


def payload_facts(raw: Column) -> list[Column]:
    """A stored text, read back: its hours, the first and the last one, and the sum of one variable."""
    time, rain = (F.from_json(object_path(raw, "hourly", name), kind) for name, kind in (("time", "array<string>"), ("rain", "array<double>")))
    return [
        F.size(time).alias("n_hours"),
        F.array_min(time).alias("first_time"),
        F.array_max(time).alias("last_time"),
        F.aggregate(rain, F.lit(0.0), lambda acc, x: acc + x).alias("sum_rain"),
    ]


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_columns(faulty_documents(read_events(spark, sf_dir)))


def _loaded(spark: SparkSession, sf_dir: str, stored: bool = True) -> Warehouse:
    """All documents loaded into a warehouse, which may hold some of them already."""
    house = Warehouse(spark, scratch_dir(spark, "load"), "api", _places(spark, sf_dir))
    if stored:
        house.append_bronze(bronze_from_events(read_events(spark, sf_dir)).filter(F.second("api_retrieval_time") < 6))
    house.load_landed(_landed(spark, sf_dir), AS_OF, retry_attempt=2)
    return house


def _with_facts(rows: DataFrame) -> DataFrame:
    return rows.select("*", *payload_facts(F.col("raw_api_response"))).drop("record_id", "raw_api_response")


@query(
    "bronze_valid",
    with_events(
        LANDED_SQL,
        select=f"SELECT {BRONZE_SELECT} FROM verdict WHERE nth = 1 AND (error_type IS NULL OR error_type = "
        "'UniqueViolation')",
    ),
)
def bronze_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_facts(_loaded(spark, sf_dir, stored=False).bronze.read())


@query(
    "bronze_unique_insert", with_events(LANDED_SQL, select=f"SELECT {BRONZE_SELECT} FROM verdict WHERE error_type IS NULL")
)
def bronze_unique_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the load itself, beside those that were there."""
    loaded = _loaded(spark, sf_dir).bronze.read().filter(F.col("created_at") == F.lit(AS_OF).cast("timestamp"))
    return _with_facts(loaded)


@query(
    "bronze_rejects",
    with_events(
        LANDED_SQL,
        select="""SELECT location_name, api_retrieval_time, error_type, error_message FROM checked
    WHERE error_type IS NOT NULL""",
    ),
)
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = bronze_plan.classify(_landed(spark, sf_dir))
    return checked.filter("_reject IS NOT NULL").select("location_name", "api_retrieval_time", "_reject.*")


VARIABLES_SQL = """variables AS (
    SELECT unnest(range(1, 14)) AS ordinal, unnest(['temperature_2m', 'apparent_temperature',
    'relative_humidity_2m', 'precipitation', 'precipitation_probability', 'weather_code', 'wind_speed_10m',
    'wind_direction_10m', 'uv_index', 'is_day', 'rain', 'showers', 'snowfall']) AS variable
)"""


@query("error_log", with_events(LANDED_SQL, VARIABLES_SQL, select=f"SELECT {ERROR_SELECT} FROM verdict WHERE error_type IS NOT NULL"))
def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).errors.read().drop("error_id", "bronze_record_id")


@query(
    "load_report",
    with_events(
        LANDED_SQL,
        select="""SELECT error_type IS NULL AS success, location_name AS location,
    CASE WHEN error_type IS NULL THEN response_time_ms END AS response_time_ms, error_message AS error FROM verdict""",
    ),
)
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).results.read().drop("result_id", "load_date")


class _Outage(Exception):
    """Stands in for a load that dies after its documents are stored."""


@query(
    "stored_results",
    with_events(
        LANDED_SQL,
        select="""SELECT error_type IS NULL AS success, location_name AS location,
    CASE WHEN error_type IS NULL THEN response_time_ms END AS response_time_ms, error_message AS error, 'result' AS kind FROM verdict
    UNION ALL SELECT NULL, NULL, NULL, error_message, 'error' FROM verdict WHERE error_type IS NOT NULL
    UNION ALL SELECT NULL, location_name, NULL, NULL, 'document' FROM verdict WHERE error_type IS NULL""",
    ),
)
def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load dies between its documents and their results and comes again: one result and one document each, and one
    error for each refusal."""
    house = Warehouse(spark, scratch_dir(spark, "results"), "api", _places(spark, sf_dir))
    house.append_bronze(bronze_from_events(read_events(spark, sf_dir)).filter(F.second("api_retrieval_time") < 6))

    def dies(*_args, **_options):
        raise _Outage

    house.log.publish = dies
    with contextlib.suppress(_Outage):
        house.load_landed(_landed(spark, sf_dir), AS_OF, retry_attempt=2)
    del house.log.publish
    house.load_landed(_landed(spark, sf_dir), "2024-02-02T00:00:00", retry_attempt=2)
    none = F.lit(None)
    results = house.results.read().drop("result_id", "load_date").withColumn("kind", F.lit("result"))
    log = house.errors.read().select(
        none.cast("boolean").alias("success"), F.get_json_object("request_params", "$.none").alias("location"),
        none.cast("double").alias("response_time_ms"), F.col("error_message").alias("error"), F.lit("error").alias("kind"),
    )
    new = house.bronze.read().filter(F.col("created_at") == F.lit(AS_OF).cast("timestamp"))
    docs = new.select(
        none.cast("boolean").alias("success"), F.col("location_name").alias("location"), none.cast("double").alias("response_time_ms"),
        none.cast("string").alias("error"), F.lit("document").alias("kind"),
    )
    return results.unionByName(log).unionByName(docs)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every location that has events, and for each of them one that never reports."""
    names = read_events(spark, sf_dir).select(F.col("event_type").alias("name")).distinct()
    both = names.select(F.explode(F.array("name", F.concat("name", F.lit("-silent")))).alias("location_name"))
    return with_variables(both)


_PLACES_SQL = """places AS (
    SELECT DISTINCT unnest([event_type, event_type || '-silent']) AS location_name FROM events
),
tally AS (
    SELECT p.location_name, count(v.error_type IS NULL) FILTER (v.fault IS NOT NULL) AS returned,
           count(*) FILTER (v.fault IS NOT NULL AND v.error_type IS NULL) AS succeeded
    FROM places p LEFT JOIN verdict v USING (location_name) GROUP BY p.location_name
)"""


@query("location_results", with_events(LANDED_SQL, _PLACES_SQL, select="SELECT * FROM tally"))
def location_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_plan.location_results(_places(spark, sf_dir), _loaded(spark, sf_dir).results.read())


@query(
    "run_summary",
    with_events(
        LANDED_SQL,
        _PLACES_SQL,
        select="""SELECT count(*) AS expected, count(*) FILTER (returned > 0) AS successful,
    count(*) FILTER (succeeded > 0) AS stored, count(*) FILTER (returned = 0) AS failed FROM tally""",
    ),
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).run_summary(_places(spark, sf_dir))


@query(
    "location_variables",
    f"""WITH {VARIABLES_SQL} SELECT location_name, ordinal, variable FROM variables,
    (SELECT DISTINCT unnest([event_type, event_type || '-silent']) AS location_name FROM events)""",
)
def location_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _places(spark, sf_dir).select("location_name", F.posexplode("hourly_variables").alias("pos", "variable"))
    return named.select("location_name", (F.col("pos") + 1).alias("ordinal"), "variable")


@query(
    "silver_rejects",
    with_events(
        """bad AS (
    SELECT record_id AS bronze_record_id, location_name, api_retrieval_time, minute(api_retrieval_time) AS fault,
           week FROM doc
)""",
        select="""SELECT bronze_record_id, location_name, api_retrieval_time, 'DataException' AS error_type,
    'cannot extract elements from a scalar' AS error_message FROM bad WHERE fault = 8
    UNION ALL SELECT bronze_record_id, location_name, api_retrieval_time, 'DataException',
    'invalid input syntax for type double precision' FROM bad WHERE fault = 7
    UNION ALL SELECT bronze_record_id, location_name, api_retrieval_time, 'NotNullViolation',
    'null value in column "observation_timestamp" violates not-null constraint' FROM bad WHERE fault = 5""",
    ),
)
def rejected_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rejects(faulty_bronze(spark, sf_dir)).select(
        "bronze_record_id", "location_name", "api_retrieval_time", "error_type", "error_message"
    )


def faulty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that pass the load although some of their hours will not reach silver."""
    docs = faulty_documents(read_events(spark, sf_dir)).withColumn("record_id", record_id())
    loadable = bronze_plan.classify(docs).filter("_reject IS NULL")
    return loadable.select(
        "record_id",
        "location_name",
        "api_retrieval_time",
        F.col("api_retrieval_time").alias("created_at"),
        F.col("api_response").alias("raw_api_response"),
    )
