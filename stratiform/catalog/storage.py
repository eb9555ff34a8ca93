"""How layers are laid out in storage: what a job reads, and what it can leave closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.base import GOLD_COLUMNS, SILVER_COLUMNS, gold_sql, latest_sql, query, with_events
from stratiform.catalog.layers import END, START, bronze
from stratiform.catalog.mutations import AS_OF, DELIVERIES_SQL, UPSERT_SQL, arriving_silver, stored_silver
from stratiform.functions.time import age
from stratiform.operators import guards
from stratiform.operators.upsert import ACTION, conditional_upsert
from stratiform.plans.gold_state import changes, gold_of, state_of, updated
from stratiform.plans.silver import silver_candidates
from stratiform.session import moment, scratch_dir
from stratiform.sources.bucketed import read_bucketed, write_bucketed
from stratiform.sources.clustered import read_between, write_clustered
from stratiform.sources.footers import footer_health, with_micros
from stratiform.sources.variant import checked_variant, read_variant, with_variant


@query("silver_variant", with_events(select=f"SELECT {SILVER_COLUMNS} FROM flat"))
def silver_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads are written as shredded variants and read back path by path."""
    path = scratch_dir(spark, "variant")
    with_variant(bronze(spark, sf_dir)).write.parquet(path)
    return guards.valid(checked_variant(read_variant(spark, path)))


BUCKETS = 8


@query(
    "silver_upsert_bucketed",
    with_events(*DELIVERIES_SQL, UPSERT_SQL, select=f"SELECT {SILVER_COLUMNS}, action FROM upserted"),
)
def silver_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored side lies in buckets of its key, and so does what the upsert writes."""
    first, second = scratch_dir(spark, "buckets"), scratch_dir(spark, "buckets")
    write_bucketed(stored_silver(spark, sf_dir), first, S.SILVER_KEY, BUCKETS)
    held = read_bucketed(spark, first, S.SILVER, S.SILVER_KEY, BUCKETS)
    merged = conditional_upsert(held, arriving_silver(spark, sf_dir), AS_OF)
    written = write_bucketed(merged, second, S.SILVER_KEY, BUCKETS, dealt=True)
    return written.withColumnRenamed(ACTION, "action").drop("id", "transformed_at")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query(
    "gold_delta",
    with_events(*DELIVERIES_SQL, UPSERT_SQL, gold_sql("gold", "upserted"), select=f"SELECT {GOLD_COLUMNS} FROM gold"),
)
def gold_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries after the second delivery, from those after the first one and the hours that changed."""
    stored, arriving = _written(stored_silver(spark, sf_dir), "stored"), _written(arriving_silver(spark, sf_dir), "arriving")
    state = _written(state_of(stored), "state")
    changed = _written(changes(stored, arriving), "changed")
    after = conditional_upsert(stored, arriving, AS_OF)
    return gold_of(updated(state, changed, after), AS_OF).drop("created_at")


@query(
    "backfill_clustered",
    with_events(
        latest_sql("latest", "flat", f"api_retrieval_time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"),
        select=f"SELECT {SILVER_COLUMNS} FROM latest",
    ),
)
def backfill_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill that opens the files of its range only."""
    path = scratch_dir(spark, "clustered")
    write_clustered(bronze(spark, sf_dir), path)
    return silver_candidates(read_between(spark, path, S.BRONZE, START, END))


@query(
    "health_footers",
    with_events(
        select="""SELECT count(*) AS row_count, max(api_retrieval_time) AS latest_data,
    epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(api_retrieval_time)) AS data_age_micros FROM doc"""
    ),
)
def health_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "footers")
    rows = with_micros(bronze(spark, sf_dir), "created_at")
    rows.write.parquet(path)
    found = footer_health(spark, path, rows.schema, "created_at")
    passed = age(moment(AS_OF), F.col("latest_data"))
    micros = F.extract(F.lit("DAY"), passed) * 86_400_000_000 + F.unix_micros(F.timestamp_micros(F.lit(0)) + passed) % 86_400_000_000
    return found.withColumn("data_age_micros", micros)
