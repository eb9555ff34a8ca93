from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import silver
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.operators.upsert import ACTION, conditional_upsert, insert_or_ignore, replacing_upsert
from stratiform.plans import quality
from stratiform.plans.backfill import silver_between
from stratiform.plans.gold import to_gold, upsert_gold

HOUR = "2026-01-01T10:00:00"
T1, T2, T3 = "2026-01-01 06:00:00", "2026-01-02 06:00:00", "2026-01-03 06:00:00"


def row(at, temperature=1.0, place="A", hour=HOUR, id=None, latitude=1.0, **more):
    return {
        "id": id, "location_name": place, "observation_timestamp": hour, "api_retrieval_time": at, "latitude": latitude,
        "temperature_2m_celsius": temperature, "bronze_record_id": 1, **more,
    }


@pytest.mark.parametrize(
    ("stored", "incoming", "action", "temperature"),
    [(T2, T1, "keep", 1.0), (T2, T2, "keep", 1.0), (T2, T3, "update", 9.0), (None, T3, "keep", 1.0), (T2, None, "keep", 1.0)],
)
def test_only_a_newer_retrieval_updates(spark, stored, incoming, action, temperature):
    old = silver(spark, row(stored, id=5, transformed_at=T1))
    new = silver(spark, row(incoming, 9.0, latitude=8.0, bronze_record_id=2))
    got = conditional_upsert(old, new, T3).collect()
    assert len(got) == 1
    assert (got[0][ACTION], got[0].temperature_2m_celsius) == (action, temperature)
    assert (got[0].id, got[0].latitude) == (5, 1.0)
    assert got[0].bronze_record_id == (2 if action == "update" else 1)
    assert got[0].transformed_at == dt.datetime(2026, 1, 3 if action == "update" else 1, 6)


def test_new_key_is_inserted_with_its_place(spark):
    old, new = silver(spark, row(T1, id=1)), silver(spark, row(T1, 2.0, "B", latitude=8.0))
    got = {r.location_name: r for r in conditional_upsert(old, new, T3).collect()}
    assert (got["B"][ACTION], got["B"].latitude, got["B"].id) == ("insert", 8.0, None)
    assert got["A"][ACTION] == "keep"


def test_batches_in_any_order_give_the_same_metrics(spark):
    batches = [
        [row(T1, 1.0), row(T1, 2.0, "B")],
        [row(T3, 3.0), row(T3, 4.0, hour="2026-01-01T11:00:00")],
        [row(T2, 5.0), row(T2, 6.0, "B")],
    ]
    results = []
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        state = silver(spark).limit(0)
        for i in order:
            state = conditional_upsert(state, silver(spark, *batches[i]), T3).drop(ACTION)
        results.append(sorted(map(tuple, state.select(*S.SILVER_KEY, "temperature_2m_celsius").collect())))
    assert results[0] == results[1] == results[2]
    assert [r[2] for r in results[0]] == [3.0, 4.0, 6.0]


def test_insert_or_ignore(spark):
    old = silver(spark, row(T1))
    new = silver(spark, row(T3, 9.0), row(T2, 7.0, "B"), row(T3, 8.0, "B"))
    got = insert_or_ignore(old, new, S.SILVER_KEY, [F.desc("api_retrieval_time")]).collect()
    assert [(r.location_name, r.temperature_2m_celsius) for r in got] == [("B", 8.0)]


def test_replacing_upsert_keeps_other_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    got = replacing_upsert(old, new, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "keep"), (2, "c", "update"), (3, "d", "insert")]


def day(spark, *values, **more):
    columns = {k: v for k, v in more.items()}
    return silver(
        spark,
        *[
            row(T1, v, hour=f"2026-01-01T{i:02d}:00:00", **{k: x[i] for k, x in columns.items()})
            for i, v in enumerate(values)
        ],
    )


def test_dominant_code(spark):
    codes = ["10.0", "10.0", "2.0", "2.0", "1.0", None, None, None]
    gold = to_gold(day(spark, *[1.0] * 8, weather_code=codes)).head()
    assert (gold.dominant_weather_code, gold.record_count) == ("10.0", 8)
    assert to_gold(day(spark, 1.0, weather_code=[None])).head().dominant_weather_code is None


def test_aggregates_skip_nulls(spark):
    gold = to_gold(day(spark, 1.0, None, 2.015, is_day=[0.5, 1.0, 1.0], rain_mm=[None, None, None])).head()
    assert gold.avg_temperature_2m_c == Decimal("1.51")
    assert (gold.min_temperature_2m_c, gold.max_temperature_2m_c) == (Decimal("1.00"), Decimal("2.02"))
    assert (gold.total_rain_mm, gold.avg_cloud_cover_percent) == (None, None)
    assert (gold.daylight_hours, gold.record_count) == (2, 3)


def test_overflow_fails(spark):
    with pytest.raises(PySparkException, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        to_gold(day(spark, 1000.0)).collect()


def test_days_are_utc_days(spark):
    late = silver(spark, row(T1, hour="2026-01-01T23:30:00+00:00"))
    assert to_gold(late).head().observation_date == dt.date(2026, 1, 1)


def test_gold_backfill_takes_whole_days(spark):
    rows = silver(spark, *[row(T1, float(h), hour=f"2026-01-0{d}T{h:02d}:00:00") for d in (1, 2, 3) for h in range(24)])
    full = {r.observation_date: r for r in to_gold(rows, T1).collect()}
    cut = to_gold(silver_between(rows, "2026-01-02T05:00:00", "2026-01-02T07:00:00"), T1).collect()
    assert [r.record_count for r in cut] == [24]
    assert cut[0] == full[dt.date(2026, 1, 2)]
    by_day = []
    for d in (1, 2, 3):
        by_day += to_gold(silver_between(rows, f"2026-01-0{d}", f"2026-01-0{d}"), T1).collect()
    assert {r.observation_date: r for r in by_day} == full


def test_gold_upsert_keeps_absent_days(spark):
    old = to_gold(silver(spark, row(T1, 1.0), row(T1, 2.0, hour="2026-01-05T00:00:00")), T1)
    new = to_gold(silver(spark, row(T1, 3.0)), T3)
    got = {r.observation_date.day: (r.avg_temperature_2m_c, r.created_at.day, r[ACTION]) for r in upsert_gold(old, new).collect()}
    assert got == {1: (Decimal("3.00"), 3, "update"), 5: (Decimal("2.00"), 1, "keep")}


def test_validation(spark):
    empty = quality.validate_silver(silver(spark).limit(0), T3).head()
    assert (empty.status, empty.total_count, empty.null_times) == ("success_no_data", 0, None)
    rows = silver(
        spark,
        row(T1, None, transformed_at="2026-01-02 06:00:01"),
        row(T1, None, "B", transformed_at="2026-01-02 06:00:00"),
    )
    found = quality.validate_silver(rows, T3).head()
    assert (found.status, found.total_count, found.recent_count, found.null_temps) == ("success", 2, 1, 1)
    broken = quality.validate_silver(silver(spark, row(T1, hour=None, transformed_at=T3)), T3).head()
    assert (broken.status, broken.null_times) == ("failed", 1)


def test_status_gate(spark):
    quality.require_completed(spark.sql("SELECT 'completed' AS status"))
    for status in ("'failed'", "NULL"):
        with pytest.raises(ValueError, match="has not completed"):
            quality.require_completed(spark.sql(f"SELECT CAST({status} AS STRING) AS status"))


def test_ranges(spark):
    found = quality.range_checks(silver(spark, row(T1, 99.0), row(T1, -99.0, "B"), row(T1, None, "C")))
    temperature = found.filter("column_name = 'temperature_2m_celsius'").head()
    assert (temperature.checked, temperature.below, temperature.above) == (2, 1, 1)


def test_health(spark):
    found = quality.health(silver(spark, row(T1), row(T2, place="B")), "t", "api_retrieval_time", T3).head()
    assert (found.table_name, found.row_count, found.data_age) == ("t", 2, dt.timedelta(days=1))
