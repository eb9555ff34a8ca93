"""Keyed streaming state, read back from the change table that the stream appends to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.catalog.base import SILVER_COLUMNS, query, with_events
from stratiform.catalog.layers import bronze
from stratiform.catalog.mutations import DELIVERIES_SQL, UPSERT_SQL
from stratiform.session import scratch_dir
from stratiform.sources.events import first_delivery
from stratiform.streaming.state import current, read_changes, start_stateful


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries arrive one after the other; between them the stream stops and starts again, and
    the last one arrives twice."""
    root = scratch_dir(spark, "state")
    rows = bronze(spark, sf_dir).drop("retrieval_date")
    for part in (first_delivery(), ~first_delivery(), ~first_delivery()):
        rows.filter(part).write.mode("append").parquet(f"{root}/arriving")
        start_stateful(spark, f"{root}/arriving", f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    return read_changes(spark, f"{root}/changes")


@query("stream_state", with_events(*DELIVERIES_SQL, UPSERT_SQL, select=f"SELECT {SILVER_COLUMNS} FROM upserted"))
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_changes(spark, sf_dir))


_KINDS = {
    "insert": ("1", "old"),
    "insert later": ("1", "upserted WHERE action = 'insert'"),
    "update": ("2", "upserted WHERE action = 'update'"),
}


@query(
    "stream_changes",
    with_events(
        *DELIVERIES_SQL,
        UPSERT_SQL,
        select=" UNION ALL ".join(
            f"SELECT {SILVER_COLUMNS}, '{kind.split()[0]}' AS action, {change} AS change FROM {source}"
            for kind, (change, source) in _KINDS.items()
        ),
    ),
)
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change once: hours that arrive for the first time, and those that a newer retrieval replaces."""
    return _changes(spark, sf_dir)
