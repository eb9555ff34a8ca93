"""Shredded payloads give the same hours as texts, and silver reads only its own arrays."""

from __future__ import annotations

import json
import re

import pytest
from conftest import bronze, hours, payload
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.catalog.mutations import faulty_bronze
from stratiform.plans.silver import checked_observations
from stratiform.session import scratch_dir
from stratiform.sources.variant import PAYLOAD, checked_variant, read_variant, with_variant

SF = "/root/testdata/sf0.001"


def stored(spark, rows, **options):
    path = scratch_dir(spark, "variant")
    with_variant(rows, **options).write.parquet(path)
    return read_variant(spark, path)


def same(spark, rows):
    expected = sorted(map(str, checked_observations(rows).collect()))
    assert sorted(map(str, checked_variant(stored(spark, rows)).collect())) == expected
    return expected


def full(spark, rows):
    missing = [c for c in S.BRONZE.names if c not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(S.BRONZE[c].dataType).alias(c) for c in missing])


def test_faulty_documents_give_the_same_rows(spark):
    rows = full(spark, faulty_bronze(spark, SF))
    expected = same(spark, rows)
    assert any("DataException" in r for r in expected) and any("NotNullViolation" in r for r in expected)
    held = stored(spark, rows)
    assert 0 < held.filter(F.col(PAYLOAD).isNull()).count() < held.count()


@pytest.mark.parametrize(
    "raw",
    [
        payload(hours(0, 1), temperature_2m=[1.5], rain=[None, 0.25], weather_code=[3.0, 61]),
        payload(hours(0), temperature_2m=["2.5"], latitude="7.25"),
        payload(hours(0), temperature_2m=["1.5d"]),
        payload(hours(0), uv_index=7),
        payload(hours(0), rain=None, snowfall=[1e300, -0.0, 12345678901234567890.5]),
        payload([None, "nonsense", *hours(2)], uv_index=[1, 2, 3]),
        payload(hours(0), latitude=None, timezone=None, weather_code=["a", None]),
        json.dumps({"hourly": {"other": [1]}}),
        json.dumps({"hourly": {"time": [], "extra": {"deep": [[1], {}]}}, "note": "é"}),
        '{"hourly":{"time":["2026-01-01T00:00:00Z"],"rain":[1],"rain":[2]}}',
    ],
)
def test_odd_documents_give_the_same_rows(spark, raw):
    same(spark, bronze(spark, (1, "A", "2026-01-01T06:00:00", raw), (2, "B", "2026-01-01T07:00:00", payload(hours(3), rain=[1.0]))))


def test_text_goes_where_a_variant_says_it_all(spark):
    rows = bronze(spark, (1, "A", "2026-01-01T06:00:00", payload(hours(0), rain=[1.0])), (2, "A", "2026-01-01T07:00:00", payload(hours(0), rain=["x"])))
    assert sorted((r.record_id, r.raw_api_response is None) for r in stored(spark, rows).collect()) == [(1, True), (2, False)]
    assert stored(spark, rows, keep_text=True).filter("raw_api_response IS NULL").count() == 0
    assert checked_variant(stored(spark, rows.limit(0))).count() == 0


def test_silver_reads_only_its_own_paths(spark):
    doc = payload(hours(0), rain=[1.0], surface_pressure=[1013.25], wind_direction_10m=[180])
    rows = stored(spark, bronze(spark, (1, "A", "2026-01-01T06:00:00", doc)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = checked_variant(rows)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    shredded, misfits = (m for m in re.findall(r"ReadSchema: struct<(.*)>", text))
    # one column for each path: 12 arrays less the spelled one, time, place and zone; no text, no other path
    assert shredded.count("array<double>") == len(S.METRICS) - len(S.TEXT_METRICS)
    assert "raw_api_response" not in shredded and "pressure" not in shredded and "raw_api_response" in misfits
    assert "IsNull" in text or "isnull" in text
