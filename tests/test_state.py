"""Keyed streaming state: corrections in any order, restarts, repeated batches."""

from __future__ import annotations

import pytest
from conftest import bronze, hours, payload

from stratiform.operators.upsert import conditional_upsert
from stratiform.plans.silver import CANDIDATE, silver_candidates
from stratiform.session import scratch_dir
from stratiform.streaming.state import PROVIDER, current, read_changes, start_stateful


@pytest.fixture
def stream(spark):
    root = scratch_dir(spark, "state")

    def arrive(*rows, write=True, **options):
        if write:
            bronze(spark, *rows).coalesce(1).write.mode("append").parquet(f"{root}/arriving")
        query = start_stateful(spark, f"{root}/arriving", f"{root}/changes", f"{root}/checkpoint", **options)
        query.awaitTermination()
        return read_changes(spark, f"{root}/changes")

    return arrive


def temperatures(changes):
    rows = current(changes).select("location_name", "observation_timestamp", "temperature_2m_celsius", "bronze_record_id")
    return sorted((r[0], r[1].hour, r[2], r[3]) for r in rows.collect())


def document(record, place, retrieved, *values, **options):
    return record, place, f"2026-01-01T{retrieved}", payload(hours(*range(len(values))), temperature_2m=list(values), **options)


def test_late_equal_and_older_corrections(stream):
    stream(document(1, "A", "06:00:00", 1.0, 2.0), document(2, "B", "06:00:00", 5.0))
    changes = stream(document(3, "A", "06:00:00", 9.0, 9.0))  # equal: nothing
    assert temperatures(changes) == [("A", 0, 1.0, 1), ("A", 1, 2.0, 1), ("B", 0, 5.0, 2)]
    changes = stream(document(4, "A", "05:59:59", 8.0, 8.0, 8.0))  # older: only the hour that was missing
    assert temperatures(changes) == [("A", 0, 1.0, 1), ("A", 1, 2.0, 1), ("A", 2, 8.0, 4), ("B", 0, 5.0, 2)]
    changes = stream(document(5, "A", "07:00:00", 3.0))  # newer
    assert temperatures(changes) == [("A", 0, 3.0, 5), ("A", 1, 2.0, 1), ("A", 2, 8.0, 4), ("B", 0, 5.0, 2)]
    assert sorted((r.action, r.change) for r in changes.collect()) == [("insert", 1)] * 4 + [("update", 2)]


def test_first_coordinates_stay_and_all_columns_equal_the_batch(spark, stream):
    first = document(1, "A", "06:00:00", 1.0, latitude=3.5, timezone="UTC")
    second = document(2, "A", "07:00:00", 2.0, 4.0, latitude=9.5, timezone="Europe/Berlin")
    stream(first)
    got = current(stream(second))
    held = silver_candidates(bronze(spark, first)).selectExpr("1L AS id", "*", "api_retrieval_time AS transformed_at")
    expected = conditional_upsert(held, silver_candidates(bronze(spark, second)), "2026-01-02")
    assert sorted(map(tuple, got.select(CANDIDATE).collect())) == sorted(map(tuple, expected.select(CANDIDATE).collect()))
    assert {r.latitude for r in got.collect()} == {3.5, 9.5}


def test_ties_within_a_batch_go_to_the_higher_id(stream):
    rows = [document(i, "A", "06:00:00", float(i)) for i in (2, 7, 5)] + [document(9, "A", "05:00:00", 9.0)]
    assert temperatures(stream(*rows)) == [("A", 0, 7.0, 7)]


def test_restart_without_news_and_one_file_at_a_time(stream):
    stream(document(1, "A", "06:00:00", 1.0))
    assert stream(write=False).count() == 1
    for i, at in enumerate(("08:00:00", "07:00:00")):
        changes = stream(document(2 + i, "A", at, float(i)), max_files=1)
    assert temperatures(changes) == [("A", 0, 0.0, 2)] and changes.count() == 2


def test_refused_hours_do_not_enter_and_settings_stay(spark, stream):
    before = spark.conf.get(PROVIDER)
    bad = (1, "A", "2026-01-01T06:00:00", payload(["nonsense", *hours(1)], temperature_2m=[1.0, 2.0]))
    assert temperatures(stream(bad)) == [("A", 1, 2.0, 1)]
    assert spark.conf.get(PROVIDER) == before
