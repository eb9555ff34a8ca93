"""Results follow documents: whatever step a load dies at, each document ends with one result."""

from __future__ import annotations

import pytest
from conftest import hours, landed, payload

from stratiform.plans.warehouse import BRONZE_ID, Warehouse
from stratiform.session import scratch_dir
from stratiform.streaming.incremental import start_incremental

D1, D2, D3 = "2026-01-01T06:00:00", "2026-01-01T07:00:00", "2026-01-01T08:00:00"


@pytest.fixture
def house(spark):
    return Warehouse(spark, scratch_dir(spark, "results"))


def doc(value=1.0):
    return payload(hours(0, 1), temperature_2m=[value, value])


def dying(house, step, run):
    """Run while one step of the load fails."""
    owner, name = step
    target = getattr(house, owner)

    def dies(*_args, **_options):
        raise OSError("gone")

    setattr(target, name, dies)
    with pytest.raises(OSError, match="gone"):
        run()
    delattr(target, name)


def outcome(house):
    results = sorted((r.location, r.success, r.response_time_ms) for r in house.results.read().collect())
    errors = sorted(e.error_type for e in house.errors.read().collect())
    return results, errors, house.bronze.read().count()


@pytest.mark.parametrize("step", [("filters", "add"), ("bronze", "publish"), ("log", "stage"), ("log", "publish")])
def test_a_load_that_died_and_came_again(spark, house, step):
    house.load_landed(landed(spark, ("Z", D1, doc())), D1)
    batch = landed(spark, ("A", D1, doc(), 10.5), ("A", D1, doc(2.0), 20.5), ("B", D1, None, 5.0), ("Z", D1, doc(), 30.0))
    dying(house, step, lambda: house.load_landed(batch, D2))
    results, errors, documents = outcome(house)
    assert sum(success for _, success, _ in results) <= documents  # no success without a document
    house.load_landed(batch, D3)
    expected = [("A", False, None), ("A", True, 10.5), ("B", False, None), ("Z", False, None), ("Z", True, 10.0)]
    assert outcome(house) == (expected, ["UniqueViolation", "UniqueViolation", "ValueError"], 2)
    again = house.load_landed(batch, D3)  # a third time all are duplicates
    assert (again["stored"], again["refused"]) == (0, 4)


def test_another_batch_finishes_what_was_left(spark, house):
    batch = landed(spark, ("A", D1, doc(), 10.5))
    dying(house, ("log", "publish"), lambda: house.load_landed(batch, D2))
    assert outcome(house) == ([], [], 1)
    house.load_landed(landed(spark, ("B", D1, doc(), 7.0)), D3)
    assert outcome(house) == ([("A", True, 11.0), ("B", True, 7.0)], [], 2)
    ids = [r.result_id for r in house.results.read().collect()]
    assert min(ids) > max(r.record_id for r in house.bronze.read().collect())


def test_rows_that_were_appended_have_no_results(spark, house):
    house.load_landed(landed(spark, ("A", D1, doc())), D1)
    other = Warehouse(spark, scratch_dir(spark, "results"))
    other.append_bronze(house.bronze.read())
    other.load_landed(landed(spark, ("A", D1, doc(), 4.0), ("B", D1, doc(), 8.0)), D2)
    assert outcome(other) == ([("A", False, None), ("B", True, 8.0)], ["UniqueViolation"], 2)


def test_stream_and_run_share_their_progress(spark, house, monkeypatch):
    parsed = []
    update = house.update_silver

    def counted(rows, *args, **options):
        parsed.append(rows.count())
        return update(rows, *args, **options)

    monkeypatch.setattr(house, "update_silver", counted)
    house.run(landed(spark, ("A", D1, doc())), D1)
    house.load_landed(landed(spark, ("A", D2, doc(2.0)), ("B", D2, doc(3.0))), D2)
    checkpoint = f"{house.root}/checkpoint"
    start_incremental(house, checkpoint, D2).awaitTermination()
    assert house.silver.version().marks[BRONZE_ID] == house.bronze.high_water()
    house.run(landed(spark, ("C", D3, doc(4.0))), D3)
    start_incremental(house, checkpoint, D3).awaitTermination()  # run has taken it in
    assert parsed == [1, 2, 1, 0]
    assert sorted({(r.location_name, r.temperature_2m_celsius) for r in house.silver.read().collect()}) == [("A", 2.0), ("B", 3.0), ("C", 4.0)]
    start_incremental(house, f"{house.root}/other", D3, max_files=1).awaitTermination()
    assert sum(parsed) == 4
