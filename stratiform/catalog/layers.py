"""Silver, gold and date-bounded runs over documents derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.catalog.base import (
    GOLD_COLUMNS,
    SILVER_COLUMNS,
    gold_sql,
    latest_sql,
    query,
    with_events,
)
from stratiform.plans.backfill import bronze_between, silver_between
from stratiform.plans.gold import to_gold
from stratiform.plans.silver import silver_candidates, to_silver
from stratiform.sources.events import bronze_from_events, read_events

START, END = "2024-01-10T06:30:00", "2024-01-20T12:15:00"


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(read_events(spark, sf_dir))


def _silver(where: str = "TRUE") -> str:
    return with_events(latest_sql("latest", "flat", where), select=f"SELECT {SILVER_COLUMNS} FROM latest")


def _gold(where: str = "TRUE") -> str:
    return with_events(
        latest_sql("latest", "flat"), gold_sql("gold", "latest", where), select=f"SELECT {GOLD_COLUMNS} FROM gold"
    )


@query("silver_flatten", with_events(select=f"SELECT {SILVER_COLUMNS} FROM flat"))
def silver_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze(spark, sf_dir))


@query("silver_latest", _silver())
def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_candidates(bronze(spark, sf_dir))


@query("gold_daily", _gold())
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(silver_candidates(bronze(spark, sf_dir))).drop("created_at")


@query("backfill_all", _silver())
def backfill_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_candidates(bronze_between(bronze(spark, sf_dir)))


@query("backfill_from", _silver(f"api_retrieval_time >= TIMESTAMP '{START}'"))
def backfill_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_candidates(bronze_between(bronze(spark, sf_dir), start=START))


@query("backfill_until", _silver(f"api_retrieval_time <= TIMESTAMP '{END}'"))
def backfill_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_candidates(bronze_between(bronze(spark, sf_dir), end=END))


@query("backfill_between", _silver(f"api_retrieval_time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"))
def backfill_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_candidates(bronze_between(bronze(spark, sf_dir), START, END))


@query("gold_backfill", _gold(f"observation_date BETWEEN '{START[:10]}' AND '{END[:10]}'"))
def gold_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(silver_between(silver_candidates(bronze(spark, sf_dir)), START, END)).drop("created_at")
