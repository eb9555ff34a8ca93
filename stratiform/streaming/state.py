"""The latest retrieval of each location and hour as keyed streaming state.

The state store holds one small value for each (location, hour): the retrieval that silver has, the
columns that keep their first values, and the number of changes. A micro-batch is compared with the state of
its own keys alone, no table is read, and only hours that change leave: new ones, and those whose retrieval is
strictly newer. They are appended to a change table; of a batch that dies neither files nor state count.

Keys are (location, hour), so a location that sends a third of all rows is spread over all tasks.
Rows of one key in a batch are taken one by one, in any order: what counts is the same as for
``latest_per_key``: the latest retrieval, then the highest bronze id. State lives in RocksDB, on disk,
so it may be larger than memory; it grows with the hours of silver, as the contract of silver keeps them all.

Defined cases. A row whose stored retrieval time is NULL is never replaced; a NULL time among new
rows counts as the latest, as in a batch. An equal or older retrieval changes nothing. Coordinates and zone keep
their first values. A batch that runs twice (restart) finds its own state uncommitted and emits the same rows.
Refused hours leave the stream by ``to_silver`` as in a batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stratiform import schemas as S
from stratiform.operators.dedup import first_per_key
from stratiform.operators.upsert import INSERT, UPDATE
from stratiform.plans.silver import CANDIDATE, to_silver

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_SILVER = T.StructType([S.SILVER[c] for c in CANDIDATE])
#: Columns of the change table: silver's own, what happened, and which change of its hour this is.
CHANGES = T.StructType([
    *(T.StructField(f.name, f.dataType) for f in _SILVER),
    T.StructField("action", T.StringType()),
    T.StructField("change", T.LongType()),
])
_FIRST = ["latitude", "longitude", "timezone"]
_RETRIEVED = "_retrieved"  # the retrieval time in microseconds, which compares alike in rows and state
_HELD = T.StructType([*(_SILVER[c] for c in _FIRST), T.StructField(_RETRIEVED, T.LongType()), CHANGES["change"]])


def _place(row: Row) -> tuple:
    """What a batch prefers: NULL times, then late ones, then high ids."""
    at, bronze_id = row[_RETRIEVED], row["bronze_record_id"]
    return at is None, at or 0, bronze_id is not None, bronze_id or 0


class LatestRetrieval(StatefulProcessor):
    """Emits a row for each key that a batch changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", _HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new = max(rows, key=_place)
        found = self.held.get()
        old = dict(zip(_HELD.names, found, strict=True)) if found is not None else None
        if old is not None and (None in (new[_RETRIEVED], old[_RETRIEVED]) or new[_RETRIEVED] <= old[_RETRIEVED]):
            return
        value = new.asDict()
        value |= {"action": INSERT, "change": 1} if old is None else {"action": UPDATE, "change": old["change"] + 1}
        value |= {c: old[c] for c in _FIRST} if old is not None else {}
        self.held.update(tuple(value[c] for c in _HELD.names))
        yield Row(**{c: value[c] for c in CHANGES.names})

    def close(self) -> None:
        pass


def changed_hours(bronze: DataFrame) -> DataFrame:
    """A stream of bronze rows -> a stream of the hours that they change in silver."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
    hours = to_silver(bronze).withColumn(_RETRIEVED, F.unix_micros("api_retrieval_time"))
    keyed = hours.groupBy(*S.SILVER_KEY)
    return keyed.transformWithState(LatestRetrieval(), CHANGES, "Append", "None")


def start_stateful(
    spark: SparkSession, source: str, target: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Append the changes of all bronze files below ``source`` that arrived since the last run to the
    change table ``target``, then stop."""
    reader = spark.readStream.schema(S.BRONZE).option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    held = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # the query takes the settings of the moment it starts
    try:
        return (
            changed_hours(reader.parquet(source))
            .writeStream.format("parquet")
            .partitionBy("observation_date")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, held)


def read_changes(spark: SparkSession, target: str) -> DataFrame:
    """All changes. A table without any has no files to read."""
    return spark.read.schema(CHANGES).parquet(target)


def current(changes: DataFrame) -> DataFrame:
    """Silver as the changes leave it: of each hour the last one."""
    return first_per_key(changes, S.SILVER_KEY, [F.desc("change")]).drop("action", "change")
