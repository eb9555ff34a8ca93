from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from stratiform.functions import numeric, text, time
from stratiform.functions.documents import first_element, is_valid_json, named_series, object_keys, object_path
from stratiform.sources.landed import hourly_frame
from stratiform.sources.locations import DEFAULT_VARIABLES, HOURLY_VARIABLES, locations, variables_or_default


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head().x


@pytest.mark.parametrize(
    ("value", "expected"),
    [(0.28499999999999992, "0.29"), (-2.345, "-2.35"), (2.675, "2.68"), (1e-9, "0.00"), (999.994, "999.99")],
)
def test_round_half_away_on_fifteen_digits(spark, value, expected):
    assert one(spark, numeric.round_numeric(F.lit(value), 5, 2)) == decimal.Decimal(expected)


def test_round_of_null_is_null(spark):
    assert one(spark, numeric.round_numeric(F.lit(None).cast("double"), 5, 2)) is None


def test_numeric_overflow_is_an_error(spark):
    with pytest.raises(ArithmeticException):
        one(spark, numeric.round_numeric(F.lit(1000.0), 5, 2))
    assert one(spark, numeric.try_round_numeric(F.lit(1000.0), 5, 2)) is None


@pytest.mark.parametrize(("value", "expected"), [(2.5, 2), (3.5, 4), (11.7, 12), (-0.5, 0)])
def test_float_to_int_is_half_even(spark, value, expected):
    assert one(spark, numeric.float_to_int(F.lit(value))) == expected


@pytest.mark.parametrize(("value", "expected"), [(2.5, 3), (-2.5, -3), (123.49, 123)])
def test_numeric_to_int_is_half_away(spark, value, expected):
    assert one(spark, numeric.numeric_to_int(F.lit(value))) == expected


@pytest.mark.parametrize(("value", "expected"), [("1.0", True), ("0.0", False), ("1", True), ("t", True), (None, None)])
def test_flags(spark, value, expected):
    assert one(spark, numeric.text_to_boolean(F.lit(value).cast("string"))) is expected


@pytest.mark.parametrize(("length", "expected"), [(999, 999), (1000, 1000), (1001, 1003), (1500, 1003)])
def test_truncate(spark, length, expected):
    cut = one(spark, text.truncate_message(F.lit("x" * length)))
    assert len(cut) == expected
    assert cut.endswith("...") is (length > 1000)


def test_clean_nested(spark):
    ts = F.lit("2026-01-01T10:00:00.5+00:00").cast("timestamp")
    raw = spark.range(1).select(
        F.struct(
            F.encode(F.lit("CÉST"), "UTF-8").alias("abbr"),
            F.array(F.struct(ts.alias("at"), F.lit(1).alias("n"))).alias("items"),
            F.create_map(F.lit("k"), F.to_timestamp(F.lit("2026-01-01 00:00:00"))).alias("m"),
            F.lit("2026-01-01 01:02:03").cast("timestamp_ntz").alias("naive"),
        ).alias("doc"),
        F.lit(None).cast("struct<b:binary>").alias("nothing"),
    )
    row = text.clean_frame(raw).head()
    assert row.doc.abbr == "CÉST"
    assert row.doc["items"][0].at == "2026-01-01T10:00:00.500000+00:00"
    assert row.doc["items"][0].n == 1
    assert row.doc.m == {"k": "2026-01-01T00:00:00+00:00"}
    assert row.doc.naive == "2026-01-01T01:02:03"
    assert row.nothing is None


@pytest.mark.parametrize(
    ("start", "end", "step", "n"), [(0, 0, 3600, 0), (10, 5, 60, 0), (0, 10800, 3600, 3), (0, 9000, 3600, 3)]
)
def test_time_axis_is_half_open(spark, start, end, step, n):
    axis = spark.range(1).select(
        F.transform(time.time_axis(F.lit(start), F.lit(end), F.lit(step)), F.unix_seconds).alias("x")
    )
    assert axis.head().x == [start + i * step for i in range(n)]


def test_elapsed_and_age(spark):
    start, end = [F.lit(f"2026-01-01 00:00:{s}").cast("timestamp") for s in ("00", "01.23456")]
    assert one(spark, time.elapsed_ms(start, end)) == 1234.56
    assert one(spark, time.age(end, start)) == dt.timedelta(seconds=1, microseconds=234560)


def test_bounds(spark):
    days = spark.createDataFrame([(d,) for d in ("01", "02", "03")], "d string")
    days = days.select(F.concat(F.lit("2026-01-"), "d").cast("timestamp").alias("ts"))
    low, high = "2026-01-01T00:00:00", "2026-01-02T00:00:00"
    assert time.between_bounds(F.col("ts")) is None
    assert time.between_bounds(F.col("ts"), "", None) is None
    assert days.filter(time.between_bounds(F.col("ts"), low, high)).count() == 2
    assert days.filter(time.between_bounds(F.col("ts"), start=high)).count() == 2
    assert days.filter(time.between_bounds(F.col("ts"), end=dt.datetime(2026, 1, 1))).count() == 1


def test_mode_labels():
    assert [time.backfill_mode(*b) for b in ((), ("a",), (None, "b"), ("a", "b"))] == ["all", "from", "until", "between"]
    assert time.utc_day("2026-01-02T23:30:00-02:00") == "2026-01-03"


@pytest.mark.parametrize(
    ("raw", "valid"), [('{"a":1}', True), ('{"a":NaN}', False), ("{", False), (None, False), ("[1,2]", True)]
)
def test_json_validity(spark, raw, valid):
    assert one(spark, is_valid_json(F.lit(raw).cast("string"))) is valid


def test_paths_keys_and_first_elements(spark):
    raw = F.lit('{"a":{"b":[3.0,null],"c":"x"}}')
    assert one(spark, object_path(raw, "a", "b")) == "[3.0,null]"
    assert one(spark, object_keys(raw, "a")) == ["b", "c"]
    assert one(spark, object_keys(raw, "a", "c")) is None
    assert one(spark, first_element(object_path(raw, "a", "b"))) == "3.0"
    assert one(spark, first_element(object_path(raw, "a", "c"))) == "x"


def test_named_series_and_hourly_frame(spark):
    row = spark.range(1).select(
        F.array(F.array(F.lit(1.5), F.lit(2.5)), F.array(F.lit(3.5))).cast("array<array<float>>").alias("v")
    )
    frame = hourly_frame(row, F.lit(0), F.lit(7200), F.lit(3600), ["temperature_2m", "rain"], F.col("v"), [])
    assert [tuple(r)[1:] for r in frame.orderBy("date_utc").collect()] == [(1.5, 3.5), (2.5, None)]
    named = row.select(named_series(F.array(F.lit("temperature_2m"), F.lit("rain")), F.col("v")).alias("x"))
    assert named.head().x == {"temperature_2m": [1.5, 2.5], "rain": [3.5]}


def test_locations(spark):
    rows = locations(spark).collect()
    assert len(rows) == 3
    assert all(r.hourly_variables == HOURLY_VARIABLES for r in rows)
    for empty in ("array()", "null"):
        assert one(spark, variables_or_default(F.expr(f"cast({empty} as array<string>)"))) == DEFAULT_VARIABLES
