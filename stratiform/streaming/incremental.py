"""New bronze files drive silver, and the touched days drive gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratiform import schemas as S
from stratiform.plans.warehouse import BRONZE_ID, Warehouse


def start_incremental(
    warehouse: Warehouse,
    checkpoint: str,
    as_of: Column | dt.datetime | str | None = None,
    max_files: int | None = None,
    source: str | None = None,
) -> StreamingQuery:
    """Process all bronze files that arrived since the last run, then stop.

    Each micro-batch upserts silver and re-aggregates the full days it touched, not the rows of
    the batch. A batch that runs twice changes nothing: its retrieval times are no longer newer.
    Files count as new however old their times are: copied or restored ones are.

    A stream over the bronze table itself shares its progress with ``Warehouse.run``: it leaves out what silver has
    taken in, and commits the highest id of its batch with silver. With ``max_files`` a batch may hold parts of loads, so
    that only leaves out and commits nothing.
    """
    spark = warehouse.spark
    reader = spark.readStream.schema(S.BRONZE).option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def apply(batch: DataFrame, _batch_id: int) -> None:
        rows = batch.select(*S.BRONZE.names)
        if source is None:
            rows = rows.filter(F.col("record_id") > warehouse.silver.version().marks.get(BRONZE_ID, 0))
        warehouse.update_silver(rows, as_of, mark_batch=source is None and max_files is None)
        warehouse.update_gold(None, as_of)

    return (
        reader.parquet(source or warehouse.bronze.path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
