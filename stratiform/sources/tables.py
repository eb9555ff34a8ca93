"""Partitioned Parquet tables that change as a whole or not at all.

A change is written into a folder of its own first and becomes part of the table in one step:

* an ``AppendTable`` has one folder per load; publishing renames the load's folder into the table.
  The folder's name is the highest id in it, so ids need no record of their own.
* a ``DayTable`` has one folder per change and day, and a small file for each version that says
  which folder holds which day. Publishing writes the next version's file under its final name.
  Folders that neither the current nor the previous version names go with a later change, so a
  reader between any two steps sees the old or the new table.

A job that dies before that step leaves the table as it was. One writer per table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.session import observed

STAGING, VERSIONS = "_staging", "_versions"
#: Ids are counted row by row across the tasks of a write, this many tasks at most.
MAX_TASKS = 1 << 17


@dataclass
class Staged:
    """A written change that is not part of the table yet."""

    path: str
    max_id: int | None = None
    metrics: dict = field(default_factory=dict)


@dataclass
class Version:
    """What a DayTable consists of: for each day the folder and the version that wrote it."""

    number: int = 0
    max_id: int = 0
    days: dict = field(default_factory=dict)
    marks: dict = field(default_factory=dict)


class _Table:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition: str, sort: list[str], id_column: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition = partition
        self.sort = sort
        self.id_column = id_column
        self._fs = FileSystem(spark, self.path)

    def ensure(self):
        """Create the table if it does not exist."""
        self._fs.mkdirs(self.path)
        return self

    def _write(self, df: DataFrame, path: str, new_rows: Column, drop: list[str], metrics: dict[str, Column], rebalance: bool) -> Staged:
        """Write a change next to the table, in one pass that also counts ``metrics``."""
        if rebalance:
            # adaptive execution splits large days over tasks and packs small ones together
            df = df.hint("rebalance", self.partition)
        df = df.sortWithinPartitions(self.partition, *self.sort)
        aggregates = [F.count("*").alias("rows")] + [c.alias(n) for n, c in metrics.items()]
        if self.id_column:
            # numbered after the last shuffle and on sorted rows: a task that runs again numbers alike
            df = df.withColumn(self.id_column, F.when(new_rows, fresh_ids(self.high_water())).otherwise(F.col(self.id_column)))
            aggregates.append(F.max(self.id_column).alias("max_id"))
        observation = Observation()
        rows = df.observe(observation, *aggregates).drop(*drop).select(*self.schema.names)
        rows.write.partitionBy(self.partition).parquet(path)
        found = dict(observed(observation) or dict.fromkeys(["rows", *metrics], 0))
        return Staged(path, found.pop("max_id", None), found)

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)


def fresh_ids(high_water: int) -> Column:
    """Ids above ``high_water``: the n-th rows of all tasks, then the next ones. A write uses about
    MAX_TASKS ids for each row of its largest task, so 64 bits last for millions of writes."""
    place = F.monotonically_increasing_id()  # task number, then 33 bits for the row
    task, row = F.shiftright(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
    number = F.lit(high_water + 1) + row * MAX_TASKS + task
    return F.when(task < MAX_TASKS, number).otherwise(F.raise_error(F.lit("a write has too many tasks")).cast("long"))


class AppendTable(_Table):
    """Rows are only added."""

    def read(self, days: list[str] | None = None, after: int | None = None) -> DataFrame:
        """All rows; or those of some days, whose folders alone are listed; or those of later loads."""
        self.ensure()
        reader = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("load", T.LongType())]))
        if days is not None:
            paths = self._fs.matching(f"{self.path}/load=*/{self.partition}={{{','.join(days)}}}") if days else []
            if not paths:
                return self._none()
            df = reader.option("basePath", self.path).parquet(*paths)
        else:
            df = reader.parquet(self.path)
        if after is not None:
            df = df.filter(F.col("load") > after).filter(F.col(self.id_column) > after)
        return df.select(*self.schema.names)

    def append(self, df: DataFrame, metrics: dict[str, Column] | None = None, rebalance: bool = False) -> dict:
        """Add rows; their ids are assigned on the way."""
        return self.publish(self.stage(df, metrics, rebalance))

    def stage(self, df: DataFrame, metrics: dict[str, Column] | None = None, rebalance: bool = False, numbered: bool = False) -> Staged:
        self.ensure()
        path = f"{self.path}/{STAGING}/{uuid.uuid4().hex}"
        return self._write(df, path, F.lit(not numbered), [], metrics or {}, rebalance)

    def publish(self, staged: Staged) -> dict:
        """Make a staged folder, or one that another job step wrote, a load of the table."""
        if not staged.metrics.get("rows"):
            self._fs.delete(staged.path)
            return staged.metrics
        self._fs.rename(staged.path, f"{self.path}/load={staged.max_id:019d}")
        self.spark.catalog.refreshByPath(self.path)
        return staged.metrics

    def days_of(self, path: str) -> list[str]:
        prefix = f"{self.partition}="
        return sorted(n.removeprefix(prefix) for n in self._fs.children(path) if n.startswith(prefix))

    def high_water(self) -> int:
        """The highest id given out so far."""
        loads = [int(n.removeprefix("load=")) for n in self._fs.children(self.path) if n.startswith("load=")]
        return max(loads, default=0)


class DayTable(_Table):
    """Days are replaced as a whole."""

    def version(self) -> Version:
        """The current version."""
        found = sorted(n for n in self._fs.children(f"{self.path}/{VERSIONS}") if n.endswith(".json"))
        return Version(**json.loads(self._fs.read(f"{self.path}/{VERSIONS}/{found[-1]}"))) if found else Version()

    def read(self, days: list[str] | None = None) -> DataFrame:
        """The table, or only some of its days: the version names their folders, nothing is listed."""
        held = self.version().days
        wanted = sorted(held) if days is None else [d for d in days if d in held]
        if not wanted:
            return self._none()
        schema = T.StructType([*self.schema.fields, T.StructField("change", T.StringType())])
        paths = [f"{self.path}/change={held[d][0]}/{self.partition}={d}" for d in wanted]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*self.schema.names)

    def replace_days(
        self, df: DataFrame, new_rows: Column, drop: list[str], metrics: dict[str, Column] | None = None, marks: dict | None = None
    ) -> dict:
        """Replace every day ``df`` has rows in; rows of ``new_rows`` get an id."""
        return self.publish(self.stage(df, new_rows, drop, metrics), marks)

    def stage(self, df: DataFrame, new_rows: Column, drop: list[str], metrics: dict[str, Column] | None = None) -> Staged:
        self._clean()
        return self._write(df, f"{self.path}/change={uuid.uuid4().hex}", new_rows, drop, metrics or {}, True)

    def publish(self, staged: Staged | None, marks: dict | None = None) -> dict:
        """The next version: the staged days in place of the old ones, and ``marks`` with them.
        Without a staged change only the marks move on."""
        new = self.version()
        new.number += 1
        if staged is not None:
            folder, prefix = staged.path.rpartition("=")[2], f"{self.partition}="
            written = [n.removeprefix(prefix) for n in self._fs.children(staged.path) if n.startswith(prefix)]
            if staged.metrics.get("rows") and not written:
                raise OSError(f"{staged.path} has gone")
            new.days |= {day: [folder, new.number] for day in written}
            new.max_id = max(new.max_id, staged.max_id or 0)
        new.marks |= marks or {}
        self._fs.write_new(f"{self.path}/{VERSIONS}/{new.number:012d}.json", json.dumps(vars(new)))
        self.spark.catalog.refreshByPath(self.path)
        return staged.metrics if staged is not None else {}

    def _clean(self) -> None:
        """Remove versions before the previous one, and folders that the last two don't name."""
        self.ensure()
        found = sorted(n for n in self._fs.children(f"{self.path}/{VERSIONS}") if n.endswith(".json"))
        for name in found[:-2]:
            self._fs.delete(f"{self.path}/{VERSIONS}/{name}")
        kept = {folder for n in found[-2:] for folder, _ in json.loads(self._fs.read(f"{self.path}/{VERSIONS}/{n}"))["days"].values()}
        for name in self._fs.children(self.path):
            if name.startswith("change=") and name.removeprefix("change=") not in kept:
                self._fs.delete(f"{self.path}/{name}")

    def days(self) -> list[str]:
        return sorted(self.version().days)

    def days_after(self, number: int) -> list[str]:
        """Days that versions after ``number`` wrote."""
        return sorted(day for day, (_, wrote) in self.version().days.items() if wrote > number)

    def high_water(self) -> int:
        """The highest id given out so far."""
        return self.version().max_id


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder this package has written."""
    FileSystem(spark, path).delete(path)


class FileSystem:
    """The few calls needed on whatever file system the path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def matching(self, pattern: str) -> list[str]:
        return [s.getPath().toString() for s in self._fs.globStatus(self._path(pattern)) or []]

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, source: str, target: str) -> None:
        if not self.exists(source) or self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def write_new(self, path: str, text: str) -> None:
        """A whole file or none; an error if another writer was first."""
        folder, _, name = path.rpartition("/")
        part = f"{folder}/.{name}-{uuid.uuid4().hex}"
        out = self._fs.create(self._path(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.rename(part, path)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
