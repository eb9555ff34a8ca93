"""Layouts: what a job reads, what it shuffles, and what it leaves closed."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from conftest import bronze, silver
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.operators.upsert import conditional_upsert, replacing_upsert
from stratiform.plans.gold import to_gold
from stratiform.plans.gold_state import changes, delta_of, gold_of, merge, state_of, updated
from stratiform.session import scratch_dir
from stratiform.sources.bucketed import read_bucketed, write_bucketed
from stratiform.sources.clustered import read_between, write_clustered
from stratiform.sources.footers import footer_health, footer_rows, with_micros


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hour(place, at, retrieved, **values):
    return {"id": 1, "location_name": place, "observation_timestamp": at, "api_retrieval_time": retrieved, "timezone": "UTC", **values}


def random_hours(seed, n=60, retrieved=None):
    r = random.Random(seed)
    rows = {}
    for _ in range(n):
        at = f"2026-01-0{r.randrange(1, 4)} {r.randrange(24):02d}:00:00"
        place = r.choice("ABC")
        values = {c: r.choice([None, round(r.uniform(-9, 9), 2)]) for c in S.METRICS.values()}
        values |= {"weather_code": r.choice([None, "0.0", "1.0", "61.0"]), "is_day": r.choice([0.0, 1.0])}
        rows[place, at] = hour(place, at, retrieved or f"2026-01-05 {r.randrange(24):02d}:00:00", **values)
    return list(rows.values())


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


# -- buckets ----------------------------------------------------------------------------


def exchanges_above_scans(text):
    """Of each scan of a bucketed table, whether an exchange stands above it and below the join."""
    found, lines = [], text.splitlines()
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            depth, above = len(line) - len(line.lstrip(" :+-*")), []
            for upper in reversed(lines[:i]):
                d = len(upper) - len(upper.lstrip(" :+-*"))
                if d < depth:
                    depth = d
                    above.append(upper)
                    if "Join" in upper:
                        break
            found.append(any("Exchange" in u for u in above))
    return found


@pytest.mark.parametrize("kind", ["silver", "gold"])
def test_only_arriving_rows_are_shuffled(spark, kind):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held, fresh = silver(spark, *random_hours(1)), silver(spark, *random_hours(2)).drop("id", "transformed_at")
        if kind == "silver":
            key, schema, upsert = S.SILVER_KEY, S.SILVER, lambda a, b: conditional_upsert(a, b, "2026-01-06")
        else:
            key, schema = S.GOLD_KEY, S.GOLD
            held, fresh = to_gold(held, "2026-01-06"), to_gold(fresh, "2026-01-06")
            upsert = lambda a, b: replacing_upsert(a, b, S.GOLD_KEY)
        path = scratch_dir(spark, "buckets")
        write_bucketed(held, path, key, 4)
        stored = read_bucketed(spark, path, schema, key, 4)
        merged = upsert(stored, fresh)
        text = plan(merged)
        assert exchanges_above_scans(text) == [False] and "FullOuter" in text
        assert rows_of(merged) == rows_of(upsert(held, fresh))
        again = write_bucketed(merged, scratch_dir(spark, "buckets"), key, 4, dealt=True)
        assert exchanges_above_scans(plan(upsert(again.drop("_action"), fresh))) == [False]
        assert rows_of(again) == rows_of(merged)
        # a bucket is one file: the result is written as it was joined
        files = {re.search(r"_(\d{5})(\.c\d+)?\.", f.rpartition("/")[2]).group(1) for f in again.inputFiles()}
        assert len(again.inputFiles()) == len(files) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- daily state ------------------------------------------------------------------------


def summaries(df):
    return rows_of(df.drop("created_at"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_delta_equals_aggregating_again(spark, seed):
    held, fresh = silver(spark, *random_hours(seed)), silver(spark, *random_hours(seed + 50)).drop("id", "transformed_at")
    after = conditional_upsert(held, fresh, "2026-01-06").drop("_action")
    changed = changes(held, fresh)
    assert 0 < changed.filter("o IS NULL").count() < changed.count() < fresh.count()
    state = updated(state_of(held), changed, after)
    expected = summaries(to_gold(after, "2026-01-06"))
    assert summaries(gold_of(state, "2026-01-06")) == expected
    assert summaries(gold_of(state_of(after), "2026-01-06")) == expected


def test_states_merge_in_any_split(spark):
    rows = random_hours(9)
    parts = [silver(spark, *rows[k::3]) for k in range(3)]
    state = state_of(parts[0])
    for part in parts[1:]:
        state = updated(state, changes(silver(spark), part), part).drop("_touched")
    assert summaries(gold_of(state)) == summaries(to_gold(silver(spark, *rows)))


def test_only_a_lost_extreme_is_looked_up(spark):
    day = [hour("A", f"2026-01-01 0{h}:00:00", "2026-01-02 00:00:00", temperature_2m_celsius=t, uv_index=1.0) for h, t in enumerate((1.0, 5.0, 9.0))]
    held = silver(spark, *day)

    def merged(place, at, value):
        fresh = silver(spark, hour(place, at, "2026-01-03 00:00:00", temperature_2m_celsius=value, uv_index=1.0)).drop("id", "transformed_at")
        return merge(state_of(held), delta_of(changes(held, fresh)))

    assert [r._lost for r in merged("A", "2026-01-01 01:00:00", 4.0).collect()] == [False]  # an inner value
    assert [r._lost for r in merged("A", "2026-01-01 02:00:00", 10.0).collect()] == [False]  # a higher maximum
    assert [r._lost for r in merged("A", "2026-01-01 02:00:00", 6.0).collect()] == [True]  # the maximum goes
    assert [r._lost for r in merged("A", "2026-01-01 00:00:00", None).collect()] == [True]  # the minimum goes
    assert sorted((r.location_name, r._lost, r._touched) for r in merged("B", "2026-01-01 00:00:00", 1.0).collect()) == [("A", False, False), ("B", False, True)]


def test_nothing_changes_without_changes(spark):
    held = silver(spark, *random_hours(4))
    same = held.drop("id", "transformed_at")
    assert changes(held, same).count() == 0
    assert summaries(gold_of(updated(state_of(held), changes(held, same), held))) == summaries(to_gold(held))
    assert gold_of(state_of(silver(spark))).count() == 0


# -- clusters ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def clustered(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(i, f"{'ABCD'[i % 4]}place", (start + dt.timedelta(minutes=37 * i)).isoformat(), "{}") for i in range(800)]
    path = scratch_dir(spark, "clustered")
    docs = bronze(spark, *rows)
    write_clustered(docs, path)
    return docs, path


@pytest.mark.parametrize(
    ("start", "end", "names"),
    [(None, None, None), ("2026-01-05T00:00:00", "2026-01-06T12:00:00", None), ("2026-01-15", None, ["Bplace"]), (None, "2026-01-02", None), (None, None, ["Cplace", "none"])],
)
def test_range_opens_its_files_only(spark, clustered, start, end, names):
    docs, path = clustered
    found = read_between(spark, path, S.BRONZE, start, end, names)
    expected = docs
    for condition in [start and F.col("created_at") >= F.lit(start).cast("timestamp"), end and F.col("created_at") <= F.lit(end).cast("timestamp")]:
        expected = expected.filter(condition) if condition is not None else expected
    expected = expected.filter(F.col("location_name").isin(names)) if names else expected
    assert rows_of(found) == rows_of(expected)
    opened, held = len(found.inputFiles()), spark.read.parquet(f"{path}/zones").count()
    assert opened == held if (start, end, names) == (None, None, None) else opened <= 0.6 * held
    if start and end:
        assert "GreaterThanOrEqual(created_at" in plan(found)


def test_clusters_of_awkward_rows(spark):
    docs = bronze(spark, (1, "A", "2026-01-01T06:00:00", "{}")).unionByName(bronze(spark, (2, "é", "2026-01-01T06:00:00", "{}")))
    rows = docs.unionByName(docs.withColumn("created_at", F.lit(None).cast("timestamp")))
    path = scratch_dir(spark, "clustered")
    write_clustered(rows, path)
    assert rows_of(read_between(spark, path, S.BRONZE)) == rows_of(rows)
    assert rows_of(read_between(spark, path, S.BRONZE, "2026-01-01", "2026-01-02")) == rows_of(docs)
    assert read_between(spark, path, S.BRONZE, "2027-01-01").count() == 0
    empty = scratch_dir(spark, "clustered")
    write_clustered(docs.limit(0), empty)
    assert read_between(spark, empty, S.BRONZE).count() == 0


# -- footers ----------------------------------------------------------------------------


def test_footers_answer_count_and_latest(spark):
    path = scratch_dir(spark, "footers")
    rows = with_micros(bronze(spark, *[(i, "A", f"2026-01-01T{i:02d}:00:00", "{}") for i in range(20)]), "created_at")
    rows.write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = footer_health(spark, path, rows.schema, "created_at")
    assert tuple(found.first()) == (20, dt.datetime(2026, 1, 1, 19))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), MAX\(created_at_us\)\]", text)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    filtered = footer_rows(spark, path, rows.schema, ["created_at_us"]).filter("created_at_us > 0").agg(F.count("*").alias("n"))
    assert filtered.first().n == 20  # with a filter rows are read, and the answer is the same
