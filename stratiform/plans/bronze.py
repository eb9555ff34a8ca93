"""Landed documents -> bronze rows, error rows and a result per document, from one judgement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.documents import CORRUPT
from stratiform.functions.numeric import numeric_to_int, try_round_numeric
from stratiform.functions.text import truncate_message
from stratiform.operators import guards
from stratiform.operators.upsert import insert_or_reject
from stratiform.sources.locations import request_params

# Messages and error types of refused documents, and what counts as empty.
EMPTY_RESPONSE = "API returned empty response"
MISSING_HOURLY = "Missing 'hourly' data in API response"
EMPTY_HOURLY = "'hourly' data is empty in API response"
INVALID_JSON = "invalid input syntax for type json"
DUPLICATE = 'duplicate key value violates unique constraint "unique_location_request"'
EMPTY_RESPONSES = ["", "[]", "null"]
EMPTY_VALUES = ['""', "[]", "0", "0.0", "false"]


def classify(landed: DataFrame) -> DataFrame:
    """Add the reject reason of every landed document; NULL for a document that may be stored."""
    if CORRUPT not in landed.columns:
        landed = landed.withColumn(CORRUPT, F.lit(None).cast("string"))
    raw = F.col("api_response")
    rules = [
        (F.col(CORRUPT).isNotNull(), guards.reason("JSONDecodeError", INVALID_JSON)),
        (raw.isNull() | F.trim(raw).isin(EMPTY_RESPONSES), guards.reason("ValueError", EMPTY_RESPONSE)),
        _document_reason(raw),
        guards.not_null("location_name"),
        guards.not_null("latitude"),
        guards.not_null("longitude"),
        guards.not_null("api_retrieval_time"),
        guards.max_width("location_name", S.LOCATION_WIDTH),
        guards.max_width("timezone", S.TIMEZONE_WIDTH),
        _numeric_range("latitude"),
        _numeric_range("longitude"),
        (F.abs("response_time_ms") >= 2**31 - 0.5, guards.reason("NumericValueOutOfRange", "integer out of range")),
    ]
    return landed.withColumn(guards.REJECT, guards.first_reason(rules)).drop(CORRUPT)


def _document_reason(raw: Column) -> Column:
    """Invalid JSON, no hourly part, or an empty one. The lambda binds the parsed document, so that
    it is parsed once however often the optimizer copies this expression."""

    def check(document: Column) -> Column:
        hourly = F.variant_get(document, "$.hourly", "variant")
        size = F.size(F.try_variant_get(document, "$.hourly", "map<string,variant>"))
        empty = F.is_variant_null(hourly) | (size == 0) | (size.isNull() & F.to_json(hourly).isin(EMPTY_VALUES))
        return (
            F.when(document.isNull(), guards.reason("JSONDecodeError", INVALID_JSON))
            .when(hourly.isNull(), guards.reason("ValueError", MISSING_HOURLY))
            .when(empty, guards.reason("ValueError", EMPTY_HOURLY))
        )

    return F.transform(F.array(F.try_parse_json(raw)), check)[0]


def _numeric_range(column: str) -> tuple[Column, Column]:
    too_large = F.col(column).isNotNull() & try_round_numeric(F.col(column), 8, 4).isNull()
    return too_large, guards.reason("NumericValueOutOfRange", "numeric field overflow")


#: What a load writes for every document besides the bronze columns; NULL where a document is stored.
REFUSED_FIELDS = ["refused", "error_type", "error_message", "request_params", "landed_latitude", "landed_longitude", "landed_time_ms"]


def judged(landed: DataFrame, now: Column, requests: DataFrame | None = None) -> DataFrame:
    """Every landed document in the bronze columns, with its refusal if it has one. A refused
    document leaves its text behind.

    The true request of a location is taken from ``requests`` (location_name, hourly_variables and
    optional forecast_days), or from columns of those names that the documents carry.
    """
    checked = with_requests(classify(landed), requests)
    reason, valid = F.col(guards.REJECT), F.col(guards.REJECT).isNull()
    stored = {
        "latitude": try_round_numeric(F.col("latitude"), 8, 4),
        "longitude": try_round_numeric(F.col("longitude"), 8, 4),
        "response_time_ms": F.when(valid, numeric_to_int(F.when(valid, F.col("response_time_ms")))),
        "raw_api_response": F.when(valid, F.col("api_response")),
        "created_at": now,
        "retrieval_date": F.to_date("api_retrieval_time"),
        "record_id": F.lit(None).cast("long"),
    }
    params = request_params(
        F.col("latitude"), F.col("longitude"), F.col("timezone"), F.col("hourly_variables"), F.col("forecast_days")
    )
    return checked.select(
        *[stored.get(name, F.col(name)).alias(name) for name in S.BRONZE.names],
        (~valid).alias("refused"),
        reason["error_type"].alias("error_type"),
        reason["error_message"].alias("error_message"),
        F.when(F.col("hourly_variables").isNotNull(), params).alias("request_params"),
        F.col("latitude").alias("landed_latitude"),
        F.col("longitude").alias("landed_longitude"),
        F.col("response_time_ms").alias("landed_time_ms"),
    )


def with_requests(landed: DataFrame, requests: DataFrame | None) -> DataFrame:
    """The variables and days requested for each document; NULL where unknown."""
    kinds = {"hourly_variables": "array<string>", "forecast_days": "int"}
    own = [c for c in kinds if c in landed.columns]
    if requests is not None:
        known = requests.select(
            F.col("location_name").alias("_place"),
            *[(F.col(c) if c in requests.columns else F.lit(None)).cast(kind).alias(f"_{c}") for c, kind in kinds.items()],
        )
        landed = landed.join(known, F.col("location_name") == F.col("_place"), "left")
    columns = []
    for c, kind in kinds.items():
        values = ([F.col(c)] if c in own else []) + ([F.col(f"_{c}")] if requests is not None else [])
        columns.append((F.coalesce(*values) if values else F.lit(None)).cast(kind).alias(c))
    rest = [c for c in landed.columns if c not in kinds and c not in ("_place", "_hourly_variables", "_forecast_days")]
    return landed.select(*[F.col(c) for c in rest], *columns)


def duplicates(batch: DataFrame, known: DataFrame) -> DataFrame:
    """The documents of a written batch whose key occurs before them, in the batch or in the table.
    The wide columns are left out before any shuffle."""
    slim = [c for c in batch.columns if c != "raw_api_response"]
    _, refused = insert_or_reject(known, batch, S.BRONZE_KEY, ["response_time_ms", "record_id"], slim)
    return refused.withColumn("error_type", F.lit("UniqueViolation")).withColumn("error_message", F.lit(DUPLICATE))


def error_rows(
    refused: DataFrame, now: Column, endpoint: str | None = None, retry_attempt: int = 0, keep: list[str] | None = None
) -> DataFrame:
    """Refused documents or hours in the error-log schema; with ``keep`` also those columns and the whole message."""
    kept = [*keep, F.col("error_message").alias("_whole_message")] if keep else []

    def given(name: str, kind: str, other: str | None = None) -> Column:
        found = next((c for c in (other, name) if c in refused.columns), None)
        return (F.col(found) if found else F.lit(None)).cast(kind)

    return refused.select(
        F.lit(None).cast("long").alias("error_id"),
        now.cast("timestamp_ntz").alias("error_timestamp"),
        F.lit(endpoint).cast("string").alias("api_endpoint"),
        "error_type",
        truncate_message(F.col("error_message")).alias("error_message"),
        given("response_status_code", "int").alias("response_status_code"),
        given("request_params", "string").alias("request_params"),
        given("latitude", "double", "landed_latitude").alias("latitude"),
        given("longitude", "double", "landed_longitude").alias("longitude"),
        F.lit(retry_attempt).alias("retry_attempt"),
        given("bronze_record_id", "long").alias("bronze_record_id"),
        F.to_date(now).alias("error_date"),
        *kept,
    )


def load_log(accepted: DataFrame, refused: DataFrame, now: Column, endpoint: str | None = None, retry_attempt: int = 0) -> DataFrame:
    """One row per document: location and response time, or location and error with what the error log says."""
    blank = [f for f in S.LOAD_LOG if f.name not in S.RESULTS.names]
    stored = accepted.select(
        F.lit(None).cast("long").alias("result_id"),
        F.lit(True).alias("success"),
        F.col("location_name").alias("location"),
        F.col("landed_time_ms").alias("response_time_ms"),
        F.lit(None).cast("string").alias("error"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in blank],
        F.to_date(now).alias("load_date"),
    )
    errors = error_rows(refused.withColumn("_location", F.col("location_name")), now, endpoint, retry_attempt, ["_location"])
    failed = errors.select(
        F.col("error_id").alias("result_id"),
        F.lit(False).alias("success"),
        F.col("_location").alias("location"),
        F.lit(None).cast("double").alias("response_time_ms"),
        F.col("_whole_message").alias("error"),
        *[f.name for f in blank],
        F.col("error_date").alias("load_date"),
    )
    return stored.unionByName(failed)


def mark_row(now: Column, like: DataFrame) -> DataFrame:
    """A row of the load log that stands for no document: its load has no results to come."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.LOAD_LOG if f.name != "load_date"]
    return like.sparkSession.range(1).select(*columns, F.to_date(now).alias("load_date"))


def results_of(log: DataFrame) -> DataFrame:
    """A result per document."""
    return log.filter(F.col("success").isNotNull()).select(*S.RESULTS.names)


def errors_of(log: DataFrame) -> DataFrame:
    """The refused documents of all loads in the error-log schema."""
    named = {"error_id": "result_id", "error_date": "load_date"}
    return log.filter(~F.col("success")).select(*[F.col(named.get(c, c)).alias(c) for c in S.ERRORS.names])


def location_results(places: DataFrame, report: DataFrame) -> DataFrame:
    """Per expected location: results returned and results that succeeded."""
    tally = report.groupBy(F.col("location").alias("location_name")).agg(
        F.count("*").alias("returned"), F.count_if("success").alias("succeeded")
    )
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("returned", "succeeded")]
    return places.select("location_name").join(tally, "location_name", "left").select("location_name", *counts)


def run_summary(places: DataFrame, report: DataFrame) -> DataFrame:
    """Expected locations, those with a result, those with a stored document, and the missing ones.

    The details are the rows of ``location_results``.
    """
    return location_results(places, report).agg(
        F.count("*").alias("expected"),
        F.count_if(F.col("returned") > 0).alias("successful"),
        F.count_if(F.col("succeeded") > 0).alias("stored"),
        F.count_if(F.col("returned") == 0).alias("failed"),
    )
