"""The three layers as stored tables and the jobs that move data between them."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform import schemas as S
from stratiform.functions.time import Bound
from stratiform.operators.dedup import first_per_key
from stratiform.operators import guards
from stratiform.operators.upsert import (
    ACTION,
    INSERT,
    KEEP,
    UPDATE,
    conditional_upsert,
    insert_or_ignore,
)
from stratiform.plans import backfill, bronze, gold, quality, silver
from stratiform.session import moment, observed, prepare
from stratiform.sources.key_filters import KeyFilters
from stratiform.sources.tables import AppendTable, DayTable, FileSystem, Staged, delete_folder, fresh_ids

AsOf = Column | dt.datetime | str | None

#: Marks that are committed with the data that makes them true: the highest bronze id that silver has
#: taken in, and the silver version that gold has aggregated.
BRONZE_ID, SILVER_VERSION = "bronze_id", "silver_version"


class ErrorLog:
    """Refused documents, as the log of loads has them, and refused hours, which the silver job writes; read as one."""

    def __init__(self, log: AppendTable, silver: AppendTable):
        self.log, self.silver = log, silver

    def read(self) -> DataFrame:
        """Both; ids of the second are odd, those of the first even."""
        both = [(bronze.errors_of(self.log.read()), 0), (self.silver.read(), 1)]
        tables = [t.withColumn("error_id", F.col("error_id") * 2 + k) for t, k in both]
        return tables[0].unionByName(tables[1])


class Results:
    """The result of every document of all loads."""

    def __init__(self, log: AppendTable):
        self.log = log

    def read(self) -> DataFrame:
        return bronze.results_of(self.log.read())


class Warehouse:
    """Bronze, error log, silver and gold under one root folder that all executors share.

    ``requests`` are the locations with what is requested for them (see ``bronze.with_requests``).
    """

    def __init__(self, spark: SparkSession, root: str, endpoint: str | None = None, requests: DataFrame | None = None):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.endpoint = endpoint
        self.requests = requests
        self.bronze = self._table(AppendTable, "bronze/weather_raw", S.BRONZE, "retrieval_date", S.BRONZE_KEY, "record_id")
        self.filters = KeyFilters(spark, f"{self.root}/bronze/key_filters")
        self.log = self._table(AppendTable, "bronze/load_log", S.LOAD_LOG, "load_date", ["location"], "result_id")
        silver_errors = self._table(AppendTable, "bronze/api_error_log/silver", S.ERRORS, "error_date", ["error_type"], "error_id")
        self.errors, self.results = ErrorLog(self.log, silver_errors), Results(self.log)
        self.silver = self._table(DayTable, "silver/weather_observations", S.SILVER, "observation_date", S.SILVER_KEY, "id")
        self.gold = self._table(DayTable, "gold/daily_weather_summary", S.GOLD, "observation_date", ["location_name"])

    def _table(self, kind, path, schema, partition, sort, id_column=None):
        return kind(self.spark, f"{self.root}/{path}", schema, partition, sort, id_column).ensure()

    @contextmanager
    def _scratch(self, name: str) -> Iterator[str]:
        """A folder under the root that goes with the step that needs it, also if the step fails."""
        path = f"{self.root}/_scratch/{name}-{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            delete_folder(self.spark, path)

    # -- landed -> bronze ---------------------------------------------------------------

    def load_landed(
        self, landed: DataFrame, as_of: AsOf = None, retry_attempt: int = 0, gather_days: bool = False
    ) -> dict:
        """Store valid documents, log refused ones, and keep a result per document.

        Documents are judged and written once, valid and refused ones apart, without a shuffle of
        their text. The unique key is then checked on the narrow columns of the written batch,
        against the stored keys of those loads that may hold one of its keys; only a batch with duplicates is
        written again without them.

        Results follow the documents: both are written, bronze is published, then the log of the load. A load that dies in
        between has documents without results; the next one gives them theirs, and a document that comes again
        then is that one, not a duplicate. ``gather_days`` shuffles a batch of many days into whole files per day.
        """
        now = moment(as_of)
        with self._scratch("load") as path:
            judged = bronze.judged(landed, now, self.requests)
            found, schema = self._write_judged(judged, path, gather_days)
            batch = self._judged(schema, f"{path}/refused=false")
            refused = self._judged(schema, f"{path}/refused=true")
            days = self.bronze.days_of(f"{path}/refused=false")
            staged = Staged(f"{path}/refused=false", found["max_id"], {"rows": found["documents"] - found["refused"]})
            with self._scratch("duplicates") as beside:
                left = self._without_results()
                repeated = self._duplicates(batch, days, beside) if days else None
                accepted = batch
                if repeated is not None:
                    accepted = batch.join(repeated.select("record_id"), "record_id", "left_anti")
                    staged = self.bronze.stage(accepted.select(*S.BRONZE.names), numbered=True)
                    staged.max_id = found["max_id"]
                    if left is not None:
                        again = first_per_key(repeated.join(left.select(*S.BRONZE_KEY), S.BRONZE_KEY, "left_semi"), S.BRONZE_KEY, [F.col("response_time_ms"), F.col("record_id")])
                        repeated = repeated.join(again.select("record_id"), "record_id", "left_anti")
                        left = _with_landed_time(left, again)
                    refused = refused.unionByName(repeated)
                stored = accepted.select("location_name", "landed_time_ms")
                if left is not None:
                    stored = stored.unionByName(left.select("location_name", "landed_time_ms"))
                log = bronze.load_log(stored, refused, now, self.endpoint, retry_attempt)
                staged_log = self._stage_log(log, staged.max_id)  # the documents move when they are published
                self._publish(staged, accepted)
                counts = self.log.publish(staged_log)
        return {
            "documents": found["documents"],
            "stored": counts["stored"],
            "refused": counts["refused"],
            "days": days,
        }

    def append_bronze(self, rows: DataFrame) -> dict:
        """Add rows that are known to be valid and new; their ids are assigned on the way."""
        numbered = rows.sortWithinPartitions("retrieval_date", *S.BRONZE_KEY).withColumn("record_id", fresh_ids(self._last_id()))
        staged = self.bronze.stage(numbered, numbered=True)
        found = self._publish(staged, self.spark.read.schema(S.BRONZE).parquet(staged.path))
        if found.get("rows"):
            self.log.publish(self._stage_log(bronze.mark_row(F.current_timestamp(), rows), staged.max_id))
        return found

    def _stage_log(self, rows: DataFrame, max_id: int | None) -> Staged:
        """The log of a load, written and not published; its ids are above those of the load's documents."""
        ids = fresh_ids(max(self._last_id(), max_id or 0))
        numbered = rows.sortWithinPartitions("load_date", "location").withColumn("result_id", ids)
        counts = {"stored": F.count_if("success"), "refused": F.count_if(~F.col("success"))}
        return self.log.stage(numbered, counts, numbered=True)

    def _last_id(self) -> int:
        """The highest id of documents and results. Both are counted together, so that the results of a load have higher
        ids than its documents, and those of the next load higher ones still."""
        return max(self.bronze.high_water(), self.log.high_water())

    def _without_results(self) -> DataFrame | None:
        """Documents of loads that died before their results were written; None if there are none."""
        last = self.log.high_water()
        if self.bronze.high_water() <= last:
            return None
        rows = self.bronze.read(after=last).select(*S.BRONZE_KEY, F.col("response_time_ms").cast("double").alias("landed_time_ms"))
        return rows

    def _publish(self, staged: Staged, rows: DataFrame) -> dict:
        if staged.metrics.get("rows"):
            self.filters.add(staged.max_id, rows)
        return self.bronze.publish(staged)

    def _known(self, batch: DataFrame, days: list[str]) -> DataFrame:
        """The stored rows of the loads and days that may hold a key of the batch; no other file is opened."""
        held = self.filters.loads(batch, days)
        folders = [f"{self.bronze.path}/load={load:019d}/retrieval_date={day}" for load, day in held]
        files = FileSystem(self.spark, self.bronze.path)
        folders = [f for f in folders if files.exists(f)]  # a load that died has left its filter only
        if not folders:
            return self.spark.createDataFrame([], S.BRONZE)
        return self.spark.read.schema(S.BRONZE).option("basePath", self.bronze.path).parquet(*folders)

    def _write_judged(self, judged: DataFrame, path: str, gather_days: bool) -> tuple[dict, T.StructType]:
        if gather_days:
            judged = judged.hint("rebalance", "retrieval_date")
        judged = judged.sortWithinPartitions("refused", "retrieval_date", *S.BRONZE_KEY)
        judged = judged.withColumn("record_id", fresh_ids(self._last_id()))
        seen = Observation()
        counted = judged.observe(
            seen, F.count("*").alias("documents"), F.count_if("refused").alias("refused"),
            F.max(F.when(~F.col("refused"), F.col("record_id"))).alias("max_id"),
        )
        counted.write.partitionBy("refused", "retrieval_date").parquet(path)
        schema = T.StructType([f for f in judged.schema.fields if f.name != "refused"])
        return observed(seen) or {"documents": 0, "refused": 0, "max_id": None}, schema

    def _judged(self, schema: T.StructType, path: str) -> DataFrame:
        found = FileSystem(self.spark, path).exists(path)
        return self.spark.read.schema(schema).parquet(path) if found else self.spark.createDataFrame([], schema)

    def _duplicates(self, batch: DataFrame, days: list[str], path: str) -> DataFrame | None:
        """Documents whose key occurs before them, written down; None if there are none."""
        found = bronze.duplicates(batch, self._known(batch, days))
        count = Observation()
        # written, so that a join with them knows their size
        found.observe(count, F.count("*").alias("n")).write.parquet(path)
        if not (observed(count) or {"n": 0})["n"]:
            return None
        return self.spark.read.schema(found.schema).parquet(path).withColumn("raw_api_response", F.lit(None).cast("string"))

    # -- bronze -> silver ---------------------------------------------------------------

    def update_silver(self, bronze_rows: DataFrame, as_of: AsOf = None, strict: bool = False, marks: dict | None = None, mark_batch: bool = False) -> dict:
        """Flatten, deduplicate and upsert; rewrites only days in which something is new or newer.

        Documents are parsed once, into hours that are valid or refused; refusals of a document are
        logged the first time. ``marks`` are committed with the change, or alone if nothing changes; with
        ``mark_batch`` that is the highest bronze id of the rows, which have to be all that are new up to it.
        """
        now = moment(as_of)
        with self._scratch("hours") as path, self._scratch("candidates") as latest:
            valid, rejected, last = self._parsed(bronze_rows, path, now, strict)
            if mark_batch and last is not None:
                marks = {BRONZE_ID: max(last, self.silver.version().marks.get(BRONZE_ID, 0))}
            candidates, days = self._written(silver.latest_per_key(valid), latest)
            changed = self._changed_days(candidates, days)
            result = {"inserted": 0, "updated": 0, "rejected": rejected, "days": changed}
            if changed:
                fresh = candidates.filter(F.col("observation_date").cast("string").isin(changed)) if changed != days else candidates
                merged = conditional_upsert(self.silver.read(changed), fresh, now)
                metrics = self.silver.replace_days(merged, F.col(ACTION) == INSERT, [ACTION], _action_counts(), marks)
                result |= {k: metrics[k] for k in ("inserted", "updated")}
            elif marks:
                self.silver.publish(None, marks)
        return result

    def _parsed(self, bronze_rows: DataFrame, path: str, now: Column, strict: bool) -> tuple[DataFrame, int, int | None]:
        """The valid hours of the documents, how many others there are (those are logged), and the highest bronze id."""
        checked = silver.checked_observations(bronze_rows)
        if strict:
            checked = guards.strict(checked).withColumn(guards.REJECT, F.lit(None).cast(guards.NO_REJECT))
        bad = Observation()
        flagged = checked.withColumn("refused", F.col(guards.REJECT).isNotNull())
        bronze_id = F.when(F.col("refused"), F.col("bronze_record_id"))
        counts = [F.count_if("refused").alias("rejected"), F.min(bronze_id).alias("low"), F.max(bronze_id).alias("high")]
        counts.append(F.max("bronze_record_id").alias("last"))
        flagged.observe(bad, *counts).write.partitionBy("refused").parquet(path)
        valid, refused = (self._judged(checked.schema, f"{path}/refused={kind}") for kind in ("false", "true"))
        seen = observed(bad) or {"rejected": 0}
        rejected = seen["rejected"]
        if rejected:
            # ids of documents grow, so a new batch meets no row group of the log
            logged = self.errors.silver.read().filter(F.col("bronze_record_id").between(seen["low"], seen["high"]))
            logged = logged.select("bronze_record_id").distinct()
            new = silver.rejects(refused).join(logged, "bronze_record_id", "left_anti")
            self.errors.silver.append(bronze.error_rows(new, now, self.endpoint))
        return valid.drop(guards.REJECT), rejected, seen.get("last")

    def _written(self, candidates: DataFrame, path: str) -> tuple[DataFrame, list[str]]:
        """The candidates written once, and their days: both the days and the upsert need them."""
        candidates.write.parquet(path)
        written = self.spark.read.schema(candidates.schema).parquet(path)
        return written, _days(written.select(F.col("observation_date").alias("day")))

    def _changed_days(self, candidates: DataFrame, days: list[str]) -> list[str]:
        """The days with an hour that is new or newer, by narrow columns only."""
        held = set(self.silver.days())
        known = [d for d in days if d in held]
        if not known:
            return days
        columns = [*S.SILVER_KEY, "api_retrieval_time", "observation_date"]
        old = self.silver.read(known).select(*S.SILVER_KEY, F.col("api_retrieval_time").alias("old"), F.lit(True).alias("known"))
        met = candidates.select(*columns).join(old, S.SILVER_KEY, "left")
        news = met.filter(F.col("known").isNull() | (F.col("api_retrieval_time") > F.col("old")))
        return _days(news.select(F.col("observation_date").alias("day")))

    def insert_silver(self, bronze_rows: DataFrame, as_of: AsOf = None) -> dict:
        """The mode that never touches a stored hour: conflicts are ignored, refusals logged."""
        now = moment(as_of)
        with self._scratch("hours") as path, self._scratch("candidates") as latest:
            valid, rejected, _ = self._parsed(bronze_rows, path, now, False)
            candidates, days = self._written(silver.latest_per_key(valid), latest)
            new = insert_or_ignore(self.silver.read(days), candidates, S.SILVER_KEY, [F.desc("api_retrieval_time")])
            changed = _days(new.select(F.col("observation_date").alias("day")))
            inserted = 0
            if changed:
                held = self.silver.read(changed).withColumn(ACTION, F.lit(KEEP))
                rows = new.withColumns({"id": F.lit(None).cast("long"), "transformed_at": now, ACTION: F.lit(INSERT)})
                both = held.unionByName(rows.select(*held.columns))
                inserted = self.silver.replace_days(both, F.col(ACTION) == INSERT, [ACTION], _action_counts())["inserted"]
        return {"inserted": inserted, "rejected": rejected, "days": changed}

    # -- silver -> gold -----------------------------------------------------------------

    def update_gold(self, days: list[str] | None = None, as_of: AsOf = None) -> dict:
        """Aggregate whole days and replace their summaries: the given ones, or all that silver has
        written since gold last looked."""
        seen = self.silver.version().number
        pending = self.silver.days_after(self.gold.version().marks.get(SILVER_VERSION, 0))
        touched = pending if days is None else days
        if not touched:
            return {"inserted": 0, "updated": 0, "days": []}
        marks = {SILVER_VERSION: seen} if set(pending) <= set(touched) else None
        new = gold.to_gold(self.silver.read(touched), as_of)
        merged = gold.upsert_gold(self.gold.read(touched), new)
        metrics = self.gold.replace_days(merged, F.lit(False), [ACTION], _action_counts(), marks)
        return {"inserted": metrics["inserted"], "updated": metrics["updated"], "days": touched}

    # -- backfill -----------------------------------------------------------------------

    def backfill_silver(self, start: Bound = None, end: Bound = None, as_of: AsOf = None) -> DataFrame:
        """Reprocess bronze created in the inclusive range; returns the one-row report."""
        result = self.update_silver(backfill.bronze_between(self.bronze.read(), start, end), as_of)
        affected = result["inserted"] + result["updated"]
        return backfill.backfill_report(quality.total_count(self.silver.read()), affected, start, end)

    def backfill_gold(self, start: Bound = None, end: Bound = None, as_of: AsOf = None) -> DataFrame:
        """Re-aggregate every day the range touches; the days are known without reading silver."""
        result = self.update_gold(backfill.days_between(self.silver.days(), start, end), as_of)
        affected = result["inserted"] + result["updated"]
        return backfill.backfill_report(quality.total_count(self.gold.read()), affected, start, end)

    def verify_backfill(self, report: DataFrame) -> DataFrame:
        quality.require_completed(report)
        return quality.verify_backfill(self.silver.read())

    # -- checks -------------------------------------------------------------------------

    def validate_silver(self, as_of: AsOf = None) -> DataFrame:
        """The check as a row; raises on NULL observation times among recent rows."""
        result = quality.validate_silver(self.silver.read(), as_of)
        failed = result.filter(F.col("status") == "failed").take(1)
        if failed:
            raise ValueError(f"Found {failed[0].null_times} null observation times!")
        return result

    def health(self, as_of: AsOf = None, layer: str = "bronze") -> DataFrame:
        """Freshness of one layer by the time its rows were written."""
        table, name, ts_column = {
            "bronze": (self.bronze, S.BRONZE_TABLE, "created_at"),
            "silver": (self.silver, S.SILVER_TABLE, "transformed_at"),
            "gold": (self.gold, S.GOLD_TABLE, "created_at"),
        }[layer]
        return quality.health(table.read(), name, ts_column, as_of)

    def run(self, landed: DataFrame, as_of: AsOf = None) -> dict:
        """One batch through all layers. Silver takes in every bronze row it hasn't seen, and gold every
        day that silver changed since, so that a run also finishes what an earlier one left undone."""
        loaded = self.load_landed(landed, as_of)
        last = self.bronze.high_water()
        before = self.silver.version().marks.get(BRONZE_ID, 0)
        silver_result = {"inserted": 0, "updated": 0, "rejected": 0, "days": []}
        if last > before:
            silver_result = self.update_silver(self.bronze.read(after=before), as_of, marks={BRONZE_ID: last})
        gold_result = self.update_gold(None, as_of)
        return {"bronze": loaded, "silver": silver_result, "gold": gold_result}

    def run_summary(self, places: DataFrame) -> DataFrame:
        """Expected locations against the stored results of all loads."""
        return bronze.run_summary(places, self.results.read())


def _with_landed_time(left: DataFrame, again: DataFrame) -> DataFrame:
    """Stored documents with the exact time of their response where they have come again."""
    met = left.join(again.select(*S.BRONZE_KEY, F.col("landed_time_ms").alias("_landed")), S.BRONZE_KEY, "left")
    return met.withColumn("landed_time_ms", F.coalesce("_landed", "landed_time_ms")).drop("_landed")


def _days(day: DataFrame) -> list[str]:
    """The distinct days, which the calendar bounds: partition names, not data."""
    found = day.filter("day IS NOT NULL").distinct().select(F.col("day").cast("string").alias("day"))
    return sorted(row.day for row in found.collect())


def _action_counts() -> dict[str, Column]:
    return {
        "inserted": F.count_if(F.col(ACTION) == INSERT),
        "updated": F.count_if(F.col(ACTION) == UPDATE),
        "kept": F.count_if(F.col(ACTION) == KEEP),
    }
