"""The physical plans: what is pushed down, what shuffles, what never appears."""

from __future__ import annotations

import re

import pytest
from conftest import bronze, hours, payload, silver

from stratiform import schemas as S
from stratiform.catalog import QUERIES
from stratiform.operators.upsert import conditional_upsert
from stratiform.plans.backfill import bronze_between
from stratiform.plans.explore import recent_observations
from stratiform.plans.gold import to_gold
from stratiform.plans.silver import silver_candidates
from stratiform.plans.warehouse import Warehouse
from stratiform.session import scratch_dir

SF = "/root/testdata/sf0.001"
WRITING = (
    "stored_", "stream_", "surrogate_", "backfill_report", "bronze_valid", "bronze_unique", "error_log", "load_report",
    "location_results", "run_summary", "landed_files",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    house = Warehouse(spark, scratch_dir(spark, "plans"))
    docs = bronze(spark, (1, "A", "2026-01-01T06:00:00", payload(hours(0), temperature_2m=[1.0])))
    house.append_bronze(docs)
    house.update_silver(house.bronze.read())
    return house


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITING)))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_bounds_reach_the_bronze_scan(stored):
    text = plan(silver_candidates(bronze_between(stored.bronze.read(), "2026-01-01", "2026-01-02")))
    assert "GreaterThanOrEqual(created_at" in text
    assert re.search(r"DataFilters: \[[^\]]*created_at#\d+ >= [^\]]*created_at#\d+ <= ", text)


def test_recent_documents_are_filtered_before_parsing(stored):
    text = plan(recent_observations(stored.bronze.read(), "2026-01-01T06:30:00"))
    assert "GreaterThan(created_at" in text


def test_silver_shuffles_once_after_a_limit_per_task(stored):
    text = plan(silver_candidates(stored.bronze.read()))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Partial" in text[text.index("Exchange hashpartitioning") :]
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "latitude" not in scan
    assert "response_time_ms" not in scan


def test_documents_are_parsed_once(stored):
    text = plan(silver_candidates(stored.bronze.read()))
    # once as numbers, and in the branch for misfits once as text
    assert text.count("from_json") == 2


def test_gold_aggregates_before_its_shuffle(stored):
    text = plan(to_gold(stored.silver.read(["2026-01-01"])))
    assert text.count("Exchange") == 1
    assert "partial_mode" in text
    assert all("observation_date=2026-01-01" in f for f in stored.silver.read(["2026-01-01"]).inputFiles())


def test_upsert_reads_touched_days_and_joins_on_the_key(spark, stored):
    text = plan(conditional_upsert(stored.silver.read(["2026-01-01"]), silver(spark), "2026-01-01"))
    assert "FullOuter" in text
    assert all("observation_date=2026-01-01" in f for f in stored.silver.read(["2026-01-01"]).inputFiles())
    assert text.count("Exchange hashpartitioning(o_") <= 1


def test_hourly_frame_makes_no_array_for_each_row(spark):
    text = plan(QUERIES["hourly_frame"](spark, SF))
    above = text[: text.index("Generate")]
    assert "slice(" not in above and text.count("Generate") == 1


def test_document_fields_need_no_join(spark):
    text = plan(QUERIES["json_path_fields"](spark, SF))
    assert "Join" not in text and text.count("Scan parquet") == 1


def test_a_load_judges_each_document_once(spark, stored):
    from conftest import landed

    from stratiform.plans.bronze import judged
    from stratiform.session import moment

    df = landed(spark, ("A", "2026-01-01T06:00:00", payload(hours(0), temperature_2m=[1.0])))
    text = plan(judged(df, moment("2026-01-02")))
    assert text.lower().count("parsejson") == 1


def test_schemas_name_their_keys():
    assert set(S.SILVER_KEY) <= set(S.SILVER.names)
    assert set(S.GOLD_KEY) <= set(S.GOLD.names)
    assert set(S.BRONZE_KEY) <= set(S.BRONZE.names)
