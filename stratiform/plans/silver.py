"""Bronze documents -> one row per location and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.documents import CORRUPT, parse_payload
from stratiform.operators import guards
from stratiform.operators.dedup import latest_per_key
from stratiform.operators.flatten import zip_longest

BAD_NUMBER = "invalid input syntax for type double precision"
BAD_TIME = "invalid input syntax for type timestamp with time zone"
BAD_ARRAY = "cannot extract elements from a scalar"

CANDIDATE = [c for c in S.SILVER.names if c not in ("id", "transformed_at")]


NUMBERS = [name for name in S.METRICS if name not in S.TEXT_METRICS]

# _p is the document read as numbers, _t the same one read as text where it does not fit
UNFIT = f"_p.{CORRUPT} IS NOT NULL"
BROKEN = f"coalesce(_t.{CORRUPT} IS NOT NULL, false)"
# the double parser also takes a Java type suffix such as '1.5d'
BAD_TEXT = """(text IS NOT NULL AND (try_cast(text AS double) IS NULL
    OR (lower(substring(rtrim(text), -1, 1)) IN ('d', 'f') AND NOT contains(lower(text), 'inf'))))"""


# a date is required: the cast alone would also take '10:00' and add the current day
BAD_TIME_TEXT = "({0} IS NOT NULL AND (try_cast({0} AS timestamp) IS NULL OR substring({0}, 5, 1) <> '-'))"


def flatten(bronze: DataFrame) -> DataFrame:
    """Hourly items, zipped by position and padded to the longest array.

    Numbers are read as doubles right away, which is twice as fast as reading texts and casting
    every item. A document that does not fit is read again as text, so that numbers in quotes
    still count and ``_bad`` marks the hours that hold something else; a document with a
    misshapen array yields one row without values, marked ``_broken``.
    """
    raw, coordinates = F.col("raw_api_response"), ["latitude", "longitude"]
    typed = parse_payload(raw, S.METRICS, [*NUMBERS, *coordinates])
    read = bronze.select(
        F.col("record_id").alias("bronze_record_id"), "location_name", "api_retrieval_time", raw, typed.alias("_p")
    )
    parsed = read.withColumn("_t", F.when(F.expr(UNFIT), parse_payload(raw, S.METRICS))).drop("raw_api_response")
    keep = [
        F.col("bronze_record_id"),
        F.col("location_name"),
        *[F.expr(f"IF({UNFIT}, try_cast(_t.{c} AS double), _p.{c}) AS {c}") for c in coordinates],
        F.expr(f"IF({UNFIT}, _t.timezone, _p.timezone) AS timezone"),
        F.col("api_retrieval_time"),
        F.expr(f"{BROKEN} AS _broken"),
        F.expr(f"{UNFIT} AND exists(array(_t.latitude, _t.longitude), text -> {BAD_TEXT}) AS _bad_place"),
    ]
    time = f"IF({BROKEN}, array(cast(NULL AS string)), {_texts('time')})"
    quoted = ", ".join(f"coalesce({_reread(name)}, array())" for name in NUMBERS)
    texts = ", ".join(f"item.`{i}`" for i in range(len(NUMBERS)))
    bad = f"transform(arrays_zip({quoted}), item -> exists(array({texts}), text -> {BAD_TEXT}))"
    items = {
        "time": time,
        "timestamp": f"try_cast({time} AS array<timestamp>)",
        **{name: _numbers(name) if name in NUMBERS else _texts(name) for name in S.METRICS},
        "bad": f"IF({UNFIT}, {bad}, cast(array() AS array<boolean>))",
    }
    return zip_longest(parsed, keep, {name: F.expr(sql) for name, sql in items.items()})


def _reread(name: str) -> str:
    return f"IF({BROKEN}, NULL, _t.hourly.{name})"


def _numbers(name: str) -> str:
    quoted = f"try_cast(coalesce({_reread(name)}, array()) AS array<double>)"
    return f"IF({UNFIT}, {quoted}, coalesce(_p.hourly.{name}, array()))"


def _texts(name: str) -> str:
    return f"coalesce(IF({UNFIT}, {_reread(name)}, _p.hourly.{name}), array())"


def checked_observations(bronze: DataFrame) -> DataFrame:
    """Typed observations with the reject reason of every row."""
    return check(flatten(bronze))


def check(rows: DataFrame) -> DataFrame:
    """Flattened rows as typed observations with the reject reason of every row."""
    timestamp = F.col("timestamp")
    rules = [
        (F.col("_broken"), guards.reason("DataException", BAD_ARRAY)),
        (F.expr(BAD_TIME_TEXT.format("time")), guards.reason("DataException", BAD_TIME)),
        (F.col("bad") | F.col("_bad_place"), guards.reason("DataException", BAD_NUMBER)),
        (
            timestamp.isNull(),
            guards.reason(
                "NotNullViolation", 'null value in column "observation_timestamp" violates not-null constraint'
            ),
        ),
        guards.not_null("location_name"),
        guards.max_width("timezone", S.TIMEZONE_WIDTH),
        guards.max_width("weather_code", S.CODE_WIDTH),
    ]
    renamed = {column: key for key, column in S.METRICS.items()}
    renamed |= {"observation_timestamp": "timestamp", "observation_date": "to_date(timestamp)"}
    flagged = rows.withColumn(guards.REJECT, guards.first_reason(rules))
    return flagged.selectExpr(*[f"{renamed.get(c, c)} AS {c}" for c in CANDIDATE], guards.REJECT)


def to_silver(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """All valid observations of ``bronze``; in strict mode the first bad row fails the job."""
    checked = checked_observations(bronze)
    return guards.strict(checked) if strict else guards.valid(checked)


def silver_rejects(bronze: DataFrame) -> DataFrame:
    """Rows ``to_silver`` leaves out, in the shape the error log takes."""
    return rejects(guards.rejected(checked_observations(bronze)))


def rejects(bad: DataFrame) -> DataFrame:
    """Refused hours in the shape the error log takes."""
    return bad.select(
        "location_name",
        "latitude",
        "longitude",
        "timezone",
        "bronze_record_id",
        "api_retrieval_time",
        f"{guards.REJECT}.error_type",
        f"{guards.REJECT}.error_message",
    )


def silver_candidates(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Latest retrieval per location and hour, ready for the upsert."""
    return latest_per_key(to_silver(bronze, strict))
