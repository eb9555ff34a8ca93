from __future__ import annotations

import random

import pytest
from conftest import bronze, hours, payload
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.operators.flatten import ordinality_join, with_ordinality, zip_longest, zip_shortest
from stratiform.plans.explore import hourly_level_keys, payload_types, recent_observations, top_level_keys
from stratiform.plans.silver import silver_candidates, silver_rejects, to_silver

T1, T2, T3 = "2026-01-01T06:00:00", "2026-01-02T06:00:00", "2026-01-03T06:00:00"


def temperatures(df):
    return [r[0] for r in df.orderBy("observation_timestamp").select("temperature_2m_celsius").collect()]


def test_shorter_array_is_padded(spark):
    df = to_silver(bronze(spark, (1, "A", T1, payload(hours(0, 1, 2), temperature_2m=[1.0, 2.0]))))
    assert temperatures(df) == [1.0, 2.0, None]


def test_missing_key_keeps_rows(spark):
    df = to_silver(bronze(spark, (1, "A", T1, payload(hours(0, 1), temperature_2m=[1.0, 2.0]))))
    assert [r.cloud_cover_percent for r in df.collect()] == [None, None]


def test_empty_arrays_give_no_rows(spark):
    docs = bronze(spark, (1, "A", T1, payload([], temperature_2m=[])), (2, "A", T2, '{"hourly":{"other":[1]}}'))
    assert to_silver(docs).count() == 0
    assert silver_rejects(docs).count() == 0


def test_longer_array_than_time(spark):
    docs = bronze(spark, (1, "A", T1, payload(hours(0, 1), temperature_2m=[1.0, 2.0, 3.0])))
    assert temperatures(to_silver(docs)) == [1.0, 2.0]
    assert [r.error_type for r in silver_rejects(docs).collect()] == ["NotNullViolation"]
    with pytest.raises(PySparkException, match="observation_timestamp"):
        to_silver(docs, strict=True).collect()


def test_null_item(spark):
    df = to_silver(bronze(spark, (1, "A", T1, payload(hours(0, 1), temperature_2m=[None, 2.0]))))
    assert temperatures(df) == [None, 2.0]


def test_text_codes_and_quoted_numbers(spark):
    docs = bronze(
        spark,
        (1, "A", T1, payload(hours(0), temperature_2m=[7], weather_code=[3.0])),
        (2, "B", T1, payload(hours(0), temperature_2m=["7.5"], weather_code=["61"], latitude="4.5")),
    )
    rows = {r.location_name: r for r in to_silver(docs).collect()}
    assert (rows["A"].temperature_2m_celsius, rows["A"].weather_code) == (7.0, "3.0")
    assert (rows["B"].temperature_2m_celsius, rows["B"].weather_code, rows["B"].latitude) == (7.5, "61", 4.5)


@pytest.mark.parametrize(
    ("document", "error", "kept"),
    [
        (payload(hours(0, 1), rain=["none", 1.0]), "invalid input syntax for type double precision", 1),
        (payload(hours(0, 1), rain=["1.5d", "inf"]), "invalid input syntax for type double precision", 1),
        (payload(hours(0, 1), rain=[True, 1]), "invalid input syntax for type double precision", 1),
        (payload(["10:00", *hours(1)], rain=[1, 2]), "invalid input syntax for type timestamp with time zone", 1),
        (payload(["2026-01-01T99:00", *hours(1)]), "invalid input syntax for type timestamp with time zone", 1),
        (payload(hours(0, 1), rain=7), "cannot extract elements from a scalar", 0),
        (payload(hours(0), timezone="z" * 51), "value too long for type character varying(50)", 0),
        (payload(hours(0), latitude="north"), "invalid input syntax for type double precision", 0),
    ],
)
def test_rejects(spark, document, error, kept):
    docs = bronze(spark, (1, "A", T1, document))
    assert [r.error_message for r in silver_rejects(docs).collect()] == [error]
    assert to_silver(docs).count() == kept


def test_latest_retrieval_wins(spark):
    docs = bronze(
        spark,
        (1, "A", T2, payload(hours(0, 1), temperature_2m=[20.0, 21.0])),
        (2, "A", T1, payload(hours(0, 1, 2), temperature_2m=[10.0, 11.0, 12.0])),
        (3, "B", T3, payload(hours(0), temperature_2m=[30.0])),
    )
    assert temperatures(silver_candidates(docs).filter("location_name = 'A'")) == [20.0, 21.0, 12.0]


def test_latest_against_brute_force_with_a_hot_key(spark):
    """A third of all documents are about the same hour of the same place."""
    rng = random.Random(7)
    rows, best = [], {}
    for i in range(300):
        place, hour = ("hot", 0) if i % 3 == 0 else (rng.choice("ab"), rng.randrange(24))
        at = f"2026-01-{rng.randrange(1, 28):02d}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00"
        rows.append((i, place, at, payload(hours(hour), temperature_2m=[float(i)])))
        best[place, hour] = max(best.get((place, hour), ("", -1)), (at, i))
    got = silver_candidates(bronze(spark, *rows).repartition(8)).collect()
    assert {(r.location_name, r.observation_timestamp.hour): r.bronze_record_id for r in got} == {
        k: v[1] for k, v in best.items()
    }


def test_zip_operators(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], ["x", "y"]), (2, [], ["z"])], "k int, l array<string>, r array<string>")
    arrays = {"l": F.col("l"), "r": F.col("r")}
    longest = zip_longest(df, [F.col("k")], arrays)
    assert sorted(map(tuple, longest.collect()), key=str) == sorted(
        [(1, "a", "x"), (1, "b", "y"), (1, "c", None), (2, None, "z")], key=str
    )
    shortest = zip_shortest(df, [F.col("k")], arrays, "n")
    assert sorted(map(tuple, shortest.collect())) == [(1, 1, "a", "x"), (1, 2, "b", "y")]
    joined = ordinality_join(df, "k", arrays, "n")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, shortest.collect()))
    numbered = with_ordinality(df, [F.col("k")], F.col("l"), "v", "n")
    assert sorted((r.k, r.n, r.v) for r in numbered.collect()) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c")]


def test_recent_observations_need_every_variable(spark):
    full = {name: [1.0, 2.0, 3.0] for name in S.METRICS}
    docs = bronze(
        spark,
        (1, "A", "2026-01-01T06:00:00", payload(hours(0, 1, 2), **full)),
        (2, "B", "2026-01-01T06:00:00", payload(hours(0, 1, 2), **{**full, "rain": [1.0]})),
        (3, "C", "2026-01-01T06:00:00", payload(hours(0), temperature_2m=[1.0])),
        (4, "D", "2026-01-01T05:00:00", payload(hours(0, 1, 2), **full)),
    )
    rows = recent_observations(docs, "2026-01-01T06:00:00").collect()
    assert sorted((r.bronze_record_id, r.rn) for r in rows) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert {r.is_day for r in rows} == {True}


def test_payload_shape(spark):
    docs = bronze(
        spark,
        (1, "A", T1, '{"latitude":1.5,"hourly":{"time":["x"],"rain":[1.5]}}'),
        (2, "A", T2, '{"timezone":"UTC","hourly":{"time":[],"uv_index":[null]}}'),
    )
    assert {r[0] for r in top_level_keys(docs).collect()} == {"latitude", "timezone", "hourly"}
    assert {r[0] for r in hourly_level_keys(docs).collect()} == {"time", "rain", "uv_index"}
    found = {(r.path, r.type): r.documents for r in payload_types(docs).collect()}
    assert found == {
        ("latitude", "number"): 1, ("timezone", "text"): 1, ("hourly", "object"): 2, ("hourly.time", "array"): 2,
        ("hourly.rain", "array"): 1, ("hourly.uv_index", "array"): 1,
    }
