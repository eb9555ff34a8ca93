from __future__ import annotations

import pytest
from conftest import hours, landed, payload
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.operators.upsert import ACTION, INSERT, conditional_upsert
from stratiform.plans.silver import silver_candidates
from stratiform.plans.warehouse import Warehouse
from stratiform.session import scratch_dir
from stratiform.sources.tables import STAGING, Staged
from stratiform.streaming.incremental import start_incremental

D1, D2, D3 = "2026-01-01T06:00:00", "2026-01-02T06:00:00", "2026-01-03T06:00:00"


def doc(first: float, day="2026-01-02", n=3):
    return payload(hours(*range(n), day=day), temperature_2m=[first + i for i in range(n)])


@pytest.fixture
def house(spark):
    return Warehouse(spark, scratch_dir(spark, "house"), endpoint="api")


def metrics(house):
    columns = [*S.SILVER_KEY, "temperature_2m_celsius", "api_retrieval_time"]
    return sorted(map(tuple, house.silver.read().select(*columns).collect()))


def test_layers_end_to_end(spark, house):
    first = house.run(landed(spark, ("A", D1, doc(1.0)), ("B", D1, doc(5.0)), ("C", D1, None)), D1)
    assert first["bronze"] == {
        "documents": 3, "stored": 2, "refused": 1, "days": ["2026-01-01"],
    }
    assert (first["silver"]["inserted"], first["silver"]["updated"], first["gold"]["inserted"]) == (6, 0, 2)
    ids = {(r.location_name, r.observation_timestamp): r.id for r in house.silver.read().collect()}

    second = house.run(landed(spark, ("A", D2, doc(10.0, n=4)), ("A", D1, doc(99.0))), D2)
    assert (second["bronze"]["stored"], second["bronze"]["refused"]) == (1, 1)
    assert (second["silver"]["inserted"], second["silver"]["updated"]) == (1, 3)
    assert (second["gold"]["inserted"], second["gold"]["updated"]) == (0, 2)
    rows = house.silver.read().collect()
    assert len({r.id for r in rows}) == len(rows) == 7
    assert all(ids.get((r.location_name, r.observation_timestamp), r.id) == r.id for r in rows)
    gold = {r.location_name: r for r in house.gold.read().collect()}
    assert (float(gold["A"].max_temperature_2m_c), gold["A"].record_count) == (13.0, 4)
    assert (float(gold["B"].max_temperature_2m_c), gold["B"].created_at.day) == (7.0, 2)
    errors = house.errors.read().orderBy("error_id").collect()
    assert [e.error_type for e in errors] == ["ValueError", "UniqueViolation"]
    assert len({e.error_id for e in errors}) == 2


def test_running_again_changes_nothing(spark, house):
    batch = landed(spark, ("A", D1, doc(1.0)))
    house.run(batch, D1)
    before = house.silver.read().collect()
    again = house.update_silver(house.bronze.read(), D2)
    assert (again["inserted"], again["updated"]) == (0, 0)
    assert sorted(house.silver.read().collect()) == sorted(before)
    assert house.load_landed(batch, D2)["stored"] == 0


def test_empty_batch(spark, house):
    nothing = landed(spark, ("A", D1, doc(1.0))).filter("false")
    result = house.run(nothing, D1)
    assert result["bronze"]["documents"] == 0
    assert result["silver"]["days"] == result["gold"]["days"] == []
    assert house.update_gold()["days"] == []
    assert house.validate_silver().head().status == "success_no_data"


def test_batch_of_refused_documents_only(spark, house):
    assert house.run(landed(spark, ("A", D1, None)), D1)["bronze"]["refused"] == 1
    assert house.errors.read().count() == 1


def test_untouched_days_are_not_rewritten(spark, house):
    house.run(landed(spark, ("A", D1, doc(1.0)), ("A", D2, doc(1.0, day="2026-01-09"))), D1)
    files = "input_file_name()"
    before = {r[0] for r in house.silver.read(["2026-01-02"]).selectExpr(files).collect()}
    house.run(landed(spark, ("A", D3, doc(2.0, day="2026-01-09"))), D3)
    assert {r[0] for r in house.silver.read(["2026-01-02"]).selectExpr(files).collect()} == before
    assert house.silver.days() == ["2026-01-02", "2026-01-09"]


def _staged_change(spark, house, place, at):
    from conftest import bronze

    candidates = silver_candidates(bronze(spark, (50, place, at, doc(50.0))))
    merged = conditional_upsert(house.silver.read(["2026-01-02"]), candidates, at)
    return house.silver.stage(merged, F.col(ACTION) == INSERT, [ACTION])


def test_change_lost_before_it_is_published(spark, house):
    house.run(landed(spark, ("A", D1, doc(1.0))), D1)
    before, held = metrics(house), house.silver.version()
    lost = _staged_change(spark, house, "A", D2)
    assert metrics(house) == before
    house.run(landed(spark, ("B", D2, doc(5.0))), D2)  # the next change cleans up
    assert not house.silver._fs.exists(lost.path)
    assert house.silver.version().number == held.number + 1


def test_reader_sees_the_old_or_the_new_table(spark, house):
    """A table read before a change keeps its rows through the change and is the new one after it."""
    house.run(landed(spark, ("A", D1, doc(1.0))), D1)
    reading, before = house.silver.read(), metrics(house)
    staged = _staged_change(spark, house, "B", D2)
    assert metrics(house) == before
    house.silver.publish(staged)
    assert reading.count() == 3
    assert [(r[0], r[2]) for r in metrics(house)] == [
        ("A", 1.0), ("A", 2.0), ("A", 3.0), ("B", 50.0), ("B", 51.0), ("B", 52.0),
    ]
    with pytest.raises(OSError, match="cannot move"):  # a second writer that started from the same version
        house.silver._fs.write_new(f"{house.silver.path}/_versions/{house.silver.version().number:012d}.json", "{}")


def test_publishing_what_is_gone_fails(spark, house):
    with pytest.raises(OSError):
        house.bronze.publish(Staged(f"{house.bronze.path}/{STAGING}/gone", 7, {"rows": 3}))
    with pytest.raises(OSError):
        house.silver.publish(Staged(f"{house.silver.path}/change=gone", 7, {"rows": 3}))


def test_two_writers_of_refusals_lose_none(spark, house):
    """A silver run is about to log a refusal while a load logs its own."""
    from stratiform.plans.bronze import error_rows
    from stratiform.session import moment

    house.load_landed(landed(spark, ("A", D1, payload(hours(0), temperature_2m=["none"]))), D1)
    rows = house.bronze.read().selectExpr("'E' AS error_type", "'m' AS error_message", "record_id AS bronze_record_id")
    staged = house.errors.silver.stage(error_rows(rows, moment(D1)))
    house.load_landed(landed(spark, ("B", D1, None), ("C", D1, None)), D1)
    house.errors.silver.publish(staged)
    found = house.errors.read().collect()
    assert sorted(e.error_type for e in found) == ["E", "ValueError", "ValueError"]
    assert len({e.error_id for e in found}) == 3


@pytest.mark.parametrize("lost", ["update_silver", "update_gold"])
def test_next_run_finishes_what_a_crash_left(spark, house, monkeypatch, lost):
    def dies(*_args, **_options):
        raise RuntimeError("lost")

    batch = landed(spark, ("A", D1, doc(1.0)), ("B", D1, doc(2.0, day="2026-01-05")))
    with monkeypatch.context() as patched:
        patched.setattr(house, lost, dies)
        with pytest.raises(RuntimeError):
            house.run(batch, D1)
    again = house.run(batch, D2)
    assert (again["bronze"]["stored"], again["bronze"]["refused"]) == (0, 2)
    assert house.silver.read().count() == 6 and house.gold.read().count() == 2
    assert not house._table(type(house.bronze), "_scratch", S.BRONZE, "retrieval_date", [])._fs.children(f"{house.root}/_scratch")


def test_second_run_writes_no_file(spark, house):
    house.run(landed(spark, ("A", D1, doc(1.0)), ("A", D2, doc(1.0, day="2026-01-09"))), D1)
    files = [{r[0] for r in t.read().selectExpr("input_file_name()").collect()} for t in (house.silver, house.gold)]
    result = house.update_silver(house.bronze.read(), D3)
    assert result["days"] == [] and house.update_gold()["days"] == []
    assert [{r[0] for r in t.read().selectExpr("input_file_name()").collect()} for t in (house.silver, house.gold)] == files


def test_refusals_are_logged_once(spark, house):
    bad = payload(hours(0, 1, 2), temperature_2m=[1.0, "none", "none"])
    house.run(landed(spark, ("A", D1, bad)), D1)
    for _ in range(2):
        assert house.update_silver(house.bronze.read(), D2)["rejected"] == 2
    assert house.errors.read().count() == 2


def test_ids_stay_dense(spark, house):
    house.load_landed(landed(spark, *[(f"p{i}", D1, doc(1.0)) for i in range(40)]).repartition(4), D1)
    ids = [r[0] for r in house.bronze.read().select("record_id").collect()]
    assert len(set(ids)) == 40 and max(ids) < 40 * (1 << 17)


def test_insert_only_mode(spark, house):
    house.run(landed(spark, ("A", D1, doc(1.0))), D1)
    house.load_landed(landed(spark, ("A", D2, doc(9.0, n=4))), D2)
    house.load_landed(landed(spark, ("C", D2, payload(hours(0), temperature_2m=["none"]))), D2)
    found = house.insert_silver(house.bronze.read(), D2)
    assert (found["inserted"], found["rejected"]) == (1, 1)
    assert [e.error_type for e in house.errors.read().collect()] == ["DataException"]
    assert [r[2] for r in metrics(house)] == [1.0, 2.0, 3.0, 12.0]
    assert house.silver.read().select("id").distinct().count() == 4


def test_backfill(spark, house):
    house.load_landed(landed(spark, ("A", D1, doc(1.0))), D1)
    house.load_landed(landed(spark, ("B", D2, doc(5.0, day="2026-01-03"))), D2)
    report = house.backfill_silver(end=D1, as_of=D3)
    row = report.head()
    assert (row.status, row.rows_affected, row.total_records, row.mode) == ("completed", 3, 3, "until")
    assert [(r.location_name, r.records) for r in house.verify_backfill(report).collect()] == [("A", 3)]
    house.backfill_silver()
    assert house.silver.read().count() == 6
    assert house.backfill_gold("2026-01-03T05:00:00").head().rows_affected == 1
    assert house.backfill_gold().head().total_records == 2
    assert house.health(D3).head().row_count == 2
    assert [house.health(D3, layer).head().row_count for layer in ("silver", "gold")] == [6, 2]


def test_day_with_rejected_hours_only(spark, house):
    """Every hour is refused: nothing reaches silver, and no refusal is lost."""
    house.load_landed(landed(spark, ("A", D1, payload(hours(0), temperature_2m=["none"]))), D1)
    result = house.update_silver(house.bronze.read(), D1)
    assert (result["inserted"], result["rejected"], result["days"]) == (0, 1, [])
    assert [e.error_type for e in house.errors.read().collect()] == ["DataException"]


def test_unfinished_backfill_is_not_verified(spark, house):
    with pytest.raises(ValueError, match="has not completed"):
        house.verify_backfill(spark.sql("SELECT 'failed' AS status"))


def test_strict_run_leaves_silver_as_it_was(spark, house):
    house.run(landed(spark, ("A", D1, doc(1.0))), D1)
    before = metrics(house)
    house.load_landed(landed(spark, ("B", D2, payload(hours(0), temperature_2m=[1.0, 2.0]))), D2)
    with pytest.raises(Exception, match="observation_timestamp"):
        house.update_silver(house.bronze.read(), D2, strict=True)
    assert metrics(house) == before


def test_stream_follows_bronze(spark, house):
    checkpoint = scratch_dir(spark, "stream")

    def follow():
        query = start_incremental(house, checkpoint, D3)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    house.load_landed(landed(spark, ("A", D2, doc(10.0)), ("B", D2, doc(20.0))), D2)
    assert follow() == 2
    # an older retrieval arrives late, and a newer one corrects an hour
    house.load_landed(landed(spark, ("A", D1, doc(0.0)), ("B", D3, doc(30.0, n=1))), D3)
    assert follow() == 2
    assert follow() == 0
    assert [(r[0], r[2]) for r in metrics(house)] == [
        ("A", 10.0), ("A", 11.0), ("A", 12.0), ("B", 30.0), ("B", 21.0), ("B", 22.0),
    ]
    gold = {r.location_name: float(r.max_temperature_2m_c) for r in house.gold.read().collect()}
    assert gold == {"A": 12.0, "B": 30.0}


def test_any_split_into_batches_gives_the_same_silver(spark):
    rows = [
        ("A", D1, doc(1.0)), ("A", D2, doc(2.0, n=2)), ("A", D3, doc(3.0, n=1)), ("B", D3, doc(4.0)), ("B", D1, doc(5.0, n=5)),
    ]
    results = []
    for split in ([rows], [rows[:2], rows[2:]], [rows[3:], rows[:3]], [[r] for r in reversed(rows)]):
        house = Warehouse(spark, scratch_dir(spark, "split"))
        for part in split:
            house.run(landed(spark, *part), D3)
        results.append(metrics(house))
    assert all(r == results[0] for r in results)


def test_old_files_are_processed_too(spark, house):
    """The stream takes in files whose times lie far behind the newest one."""
    import os
    import time

    arriving = house.root.removeprefix("file://") + "/arriving"
    house.load_landed(landed(spark, ("A", D1, doc(1.0)), ("B", D1, doc(2.0))), D1)

    def deliver(place):
        house.bronze.read().filter(F.col("location_name") == place).drop("retrieval_date").write.mode("append").parquet(arriving)

    def follow():
        start_incremental(house, f"{house.root}/checkpoint", D3, source=arriving).awaitTermination()

    deliver("A")
    follow()
    known = set(os.listdir(arriving))
    deliver("B")
    long_ago = time.time() - 30 * 86_400
    for name in set(os.listdir(arriving)) - known:
        os.utime(f"{arriving}/{name}", (long_ago, long_ago))
    follow()
    assert {r[0] for r in metrics(house)} == {"A", "B"}


def test_scratch_is_shared(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
