"""Stored tables and streams: results are read back from what the jobs wrote."""

from __future__ import annotations

import contextlib
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.base import GOLD_COLUMNS, SILVER_COLUMNS, gold_sql, latest_sql, query, with_events
from stratiform.catalog.layers import END, START, bronze
from stratiform.catalog.mutations import AS_OF, DELIVERIES_SQL, UPSERT_SQL
from stratiform.functions.documents import CORRUPT, object_path
from stratiform.plans.warehouse import Warehouse
from stratiform.session import scratch_dir
from stratiform.sources.events import first_delivery, landed_columns, landed_documents, read_events
from stratiform.sources.landed import read_landed
from stratiform.streaming.incremental import start_incremental


def _warehouse(spark: SparkSession, name: str) -> Warehouse:
    return Warehouse(spark, scratch_dir(spark, name))


def _two_deliveries(spark: SparkSession, sf_dir: str) -> Warehouse:
    house = _warehouse(spark, "deliveries")
    landed = landed_documents(read_events(spark, sf_dir))
    for part in (first_delivery(), ~first_delivery()):
        house.run(landed_columns(landed.filter(part)), AS_OF)
    return house


_STORED = "location_name, latitude, longitude, timezone, observation_timestamp, " + ", ".join(
    [*S.METRICS.values(), "api_retrieval_time", "observation_date"]
)


@query("stored_silver", with_events(*DELIVERIES_SQL, UPSERT_SQL, select=f"SELECT {_STORED} FROM upserted"))
def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _two_deliveries(spark, sf_dir).silver.read()
    return silver.drop("id", "bronze_record_id", "transformed_at")


@query(
    "stored_gold",
    with_events(
        *DELIVERIES_SQL, UPSERT_SQL, gold_sql("gold", "upserted"), select=f"SELECT {GOLD_COLUMNS} FROM gold"
    ),
)
def stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_deliveries(spark, sf_dir).gold.read().drop("created_at")


@query(
    "surrogate_keys",
    with_events(
        *DELIVERIES_SQL,
        UPSERT_SQL,
        select="""SELECT count(*) AS records, count(*) AS ids, count(*) FILTER (action <> 'insert') AS kept_ids,
    count(*) FILTER (action = 'insert') AS later_ids FROM upserted""",
    ),
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are unique, survive an update, and later rows get higher ones."""
    house = _warehouse(spark, "keys")
    landed = landed_documents(read_events(spark, sf_dir))
    house.run(landed_columns(landed.filter(first_delivery())), AS_OF)
    before = house.silver.read().select(*S.SILVER_KEY, F.col("id").alias("old_id"))
    copy = scratch_dir(spark, "ids")
    before.write.parquet(copy)
    last_id = house.silver.high_water()
    house.run(landed_columns(landed.filter(~first_delivery())), AS_OF)
    after = house.silver.read().join(spark.read.parquet(copy), S.SILVER_KEY, "left")
    return after.agg(
        F.count("*").alias("records"),
        F.countDistinct("id").alias("ids"),
        F.count_if(F.col("id") == F.col("old_id")).alias("kept_ids"),
        F.count_if(F.col("id") > last_id).alias("later_ids"),
    )


@query(
    "backfill_report",
    with_events(
        latest_sql("latest", "flat", f"api_retrieval_time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"),
        select=f"""SELECT 'completed' AS status, count(*) AS rows_affected, count(*) AS total_records,
    '{START}' AS start_date, '{END}' AS end_date, 'between' AS mode FROM latest""",
    ),
)
def backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _warehouse(spark, "backfill")
    house.append_bronze(bronze(spark, sf_dir))
    return house.backfill_silver(START, END, AS_OF)


_BOUNDS = {"all": (None, None), "from": (START, None), "until": (None, END), "between": (START, END)}


def _range_sql(label: str, start: str | None, end: str | None) -> str:
    days = [f"observation_date >= '{start[:10]}'"] if start else []
    days += [f"observation_date <= '{end[:10]}'"] if end else []
    texts = ["NULL" if b is None else f"'{b}'" for b in (start, end)]
    return f"""SELECT 'completed' AS status, count(*) FILTER ({" AND ".join(days) or "TRUE"}) AS rows_affected,
    count(*) AS total_records, {texts[0]} AS start_date, {texts[1]} AS end_date, '{label}' AS mode FROM gold"""


@query(
    "stored_gold_backfill",
    with_events(
        latest_sql("latest", "flat"),
        gold_sql("gold", "latest"),
        select=" UNION ALL ".join(_range_sql(label, *bounds) for label, bounds in _BOUNDS.items()),
    ),
)
def stored_gold_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days are aggregated again, however the bounds cut them."""
    house = _warehouse(spark, "backfill")
    house.append_bronze(bronze(spark, sf_dir))
    house.update_silver(house.bronze.read(), AS_OF)
    reports = [house.backfill_gold(*bounds, AS_OF) for bounds in _BOUNDS.values()]
    return functools.reduce(DataFrame.unionByName, reports)


class _Outage(Exception):
    """Stands in for a job that dies between two layers."""


@query(
    "stored_resume",
    with_events(
        *DELIVERIES_SQL,
        UPSERT_SQL,
        gold_sql("gold", "upserted"),
        select=f"""SELECT {GOLD_COLUMNS}, silver_rows, latest FROM gold JOIN (
    SELECT observation_date, location_name, count(*) AS silver_rows, max(api_retrieval_time) AS latest
    FROM upserted GROUP BY observation_date, location_name) USING (observation_date, location_name)""",
    ),
)
def stored_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run dies before silver and the next before gold; the batches come again, and nothing is lost."""
    house = _warehouse(spark, "resume")
    landed = landed_documents(read_events(spark, sf_dir))
    for part, lost in ((first_delivery(), "update_silver"), (~first_delivery(), "update_gold")):
        batch = landed_columns(landed.filter(part))

        def dies(*_args, **_options):
            raise _Outage

        setattr(house, lost, dies)
        with contextlib.suppress(_Outage):
            house.run(batch, AS_OF)
        delattr(house, lost)
    house.run(landed_columns(landed.filter(~first_delivery())), AS_OF)
    latest = F.max("api_retrieval_time").alias("latest")
    days = house.silver.read().groupBy("observation_date", "location_name").agg(F.count("*").alias("silver_rows"), latest)
    return house.gold.read().drop("created_at").join(days, ["observation_date", "location_name"])


def _streamed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The two deliveries arrive one after the other, each in as many files as tasks wrote it."""
    house = _warehouse(spark, "stream")
    rows = bronze(spark, sf_dir)
    for part in (first_delivery(), ~first_delivery()):
        rows.filter(part).drop("retrieval_date").write.mode("append").parquet(f"{house.root}/arriving")
        query = start_incremental(house, f"{house.root}/checkpoint", AS_OF, source=f"{house.root}/arriving")
        query.awaitTermination()
    return house


@query(
    "landed_files",
    with_events(
        select="""SELECT location_name, latitude, longitude, 'UTC' AS timezone, api_retrieval_time, response_time_ms, n_hours,
    CAST(NULL AS VARCHAR) AS broken FROM doc UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    '{"location_name":"' || location_name || '","user":' || user_id || ',"week":' || week FROM doc
    WHERE minute(api_retrieval_time) = 3"""
    ),
)
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines, some lines torn off, read as a landed folder."""
    docs = landed_documents(read_events(spark, sf_dir))
    at = F.date_format("api_retrieval_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("api_retrieval_time")
    whole = docs.select(F.to_json(F.struct(*[at if c == "api_retrieval_time" else F.col(c) for c in S.LANDED.names])).alias("value"))
    torn = docs.filter(F.minute("api_retrieval_time") == 3).select(
        F.concat(F.lit('{"location_name":"'), "location_name", F.lit('","user":'), "user_id", F.lit(',"week":'), "week").alias("value")
    )
    folder = scratch_dir(spark, "landed")
    whole.unionByName(torn).write.text(folder)
    found = read_landed(spark, folder)
    hours = F.json_array_length(object_path(F.col("api_response"), "hourly", "time"))
    return found.select(*[c for c in S.LANDED.names if c != "api_response"], hours.alias("n_hours"), F.col(CORRUPT).alias("broken"))


@query("stream_silver", with_events(*DELIVERIES_SQL, UPSERT_SQL, select=f"SELECT {SILVER_COLUMNS} FROM upserted"))
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).silver.read().drop("id", "transformed_at")


@query(
    "stream_gold",
    with_events(
        *DELIVERIES_SQL, UPSERT_SQL, gold_sql("gold", "upserted"), select=f"SELECT {GOLD_COLUMNS} FROM gold"
    ),
)
def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).gold.read().drop("created_at")
