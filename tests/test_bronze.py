from __future__ import annotations

import json

import pytest
from conftest import bronze, hours, landed, payload
from pyspark.sql import functions as F

from stratiform.plans.bronze import classify, location_results, run_summary
from stratiform.plans.warehouse import Warehouse
from stratiform.session import scratch_dir
from stratiform.sources.landed import read_landed
from stratiform.sources.locations import with_variables

T1, T2 = "2026-01-01T06:00:00", "2026-01-02T06:00:00"
GOOD = payload(hours(0), temperature_2m=[1.0])


def load(spark, df, stored=None, retry_attempt=0, requests=None):
    """A warehouse that has loaded ``df``, and what the load returned."""
    house = Warehouse(spark, scratch_dir(spark, "load"), "api", requests)
    if stored is not None:
        house.append_bronze(stored)
    return house, house.load_landed(df, T2, retry_attempt)


@pytest.mark.parametrize(
    ("document", "error"),
    [
        (None, "API returned empty response"),
        ("  ", "API returned empty response"),
        ("[]", "API returned empty response"),
        ('{"latitude":1}', "Missing 'hourly' data in API response"),
        ('["hourly"]', "Missing 'hourly' data in API response"),
        ('{"hourly": { }}', "'hourly' data is empty in API response"),
        ('{"hourly":null}', "'hourly' data is empty in API response"),
        ('{"hourly":[]}', "'hourly' data is empty in API response"),
        ('{"hourly":0}', "'hourly' data is empty in API response"),
        ('{"hourly":""}', "'hourly' data is empty in API response"),
        ('{"hourly":{"rain":[NaN]}}', "invalid input syntax for type json"),
        ('{"hourly":', "invalid input syntax for type json"),
    ],
)
def test_refused_documents(spark, document, error):
    rows = classify(landed(spark, ("A", T1, document), ("A", T2, GOOD))).orderBy("api_retrieval_time").collect()
    assert rows[0]._reject.error_message == error
    assert rows[1]._reject is None


@pytest.mark.parametrize(
    ("column", "value", "error"),
    [
        ("location_name", None, "NotNullViolation"),
        ("latitude", None, "NotNullViolation"),
        ("api_retrieval_time", None, "NotNullViolation"),
        ("location_name", "x" * 101, "StringDataRightTruncation"),
        ("timezone", "x" * 51, "StringDataRightTruncation"),
        ("longitude", 10000.0, "NumericValueOutOfRange"),
        ("longitude", 9999.99995, "NumericValueOutOfRange"),
        ("longitude", 1e30, "NumericValueOutOfRange"),
        ("response_time_ms", 3e9, "NumericValueOutOfRange"),
    ],
)
def test_constraints(spark, column, value, error):
    df = landed(spark, ("A", T1, GOOD))
    df = df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))
    assert classify(df).head()._reject.error_type == error
    house, found = load(spark, df)
    assert (found["documents"], found["stored"], found["refused"]) == (1, 0, 1)
    assert house.bronze.read().count() == 0
    assert [e.error_type for e in house.errors.read().collect()] == [error]


def test_coordinates_and_response_time(spark):
    df = landed(spark, ("A", T1, GOOD, 12.5)).withColumn("latitude", F.lit(1.00005))
    row = load(spark, df)[0].bronze.read().head()
    assert (str(row.latitude), row.response_time_ms, row.raw_api_response) == ("1.0001", 13, GOOD)


def test_duplicates_in_batch_and_table(spark):
    rows = [("A", T1, GOOD, 30.0), ("A", T1, GOOD, 20.0), ("A", T1, GOOD, 20.0), ("A", T2, GOOD), ("B", T1, GOOD)]
    house, found = load(spark, landed(spark, *rows), bronze(spark, (1, "B", T1, GOOD)), 1)
    new = house.bronze.read().filter(F.col("created_at") == F.lit(T2).cast("timestamp"))
    assert sorted((r.location_name, r.response_time_ms) for r in new.collect()) == [("A", 10), ("A", 20)]
    errors = house.errors.read().collect()
    assert [e.error_type for e in errors] == ["UniqueViolation"] * 3
    assert {(e.api_endpoint, e.retry_attempt, e.latitude) for e in errors} == {("api", 1, 1.25)}
    assert house.results.read().filter("not success").count() == found["refused"] == 3
    assert house.bronze.read().select("record_id").distinct().count() == 3


def test_error_log_states_the_true_request(spark):
    places = spark.createDataFrame([("A",), ("B",)], "location_name string")
    requests = with_variables(places.filter("location_name = 'A'"), ["rain", "is_day"])
    df = landed(spark, ("A", T1, None), ("B", T1, None), (None, T1, GOOD))
    house, _ = load(spark, df, requests=requests)
    known = sorted(json.dumps(json.loads(e.request_params)["hourly"]) for e in house.errors.read().collect() if e.request_params)
    assert known == ['["rain", "is_day"]']
    carried = df.withColumn("hourly_variables", F.array(F.lit("snowfall"))).withColumn("forecast_days", F.lit(3))
    errors = load(spark, carried)[0].errors.read().collect()
    assert {(*json.loads(e.request_params)["hourly"], json.loads(e.request_params)["forecast_days"]) for e in errors} == {("snowfall", 3)}


def test_hot_key_keeps_every_refusal(spark):
    """Copies of one document, spread over all partitions: one is stored, each other one is refused."""
    one = landed(spark, ("hot", T1, GOOD))
    copies = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n").repartition(8)
    others = landed(spark, *[(f"p{i}", T1, GOOD) for i in range(100)])
    house, found = load(spark, copies.unionByName(others))
    assert house.bronze.read().count() == found["stored"] == 101
    assert house.errors.read().count() == found["refused"] == 499
    assert house.results.read().count() == 600


def test_summary_counts_missing_locations(spark):
    house, _ = load(spark, landed(spark, ("A", T1, GOOD), ("B", T1, None)))
    report = house.results.read()
    places = spark.createDataFrame([("A",), ("B",), ("C",)], "location_name string")
    assert [(r.location_name, r.returned, r.succeeded) for r in location_results(places, report).orderBy("location_name").collect()] == [
        ("A", 1, 1), ("B", 1, 0), ("C", 0, 0),
    ]
    assert house.run_summary(places).head() == run_summary(places, report).head()
    assert run_summary(places, report).head().asDict() == {"expected": 3, "successful": 2, "stored": 1, "failed": 1}


def test_read_landed_lines(spark, tmp_path):
    lines = [
        '{"location_name":"A","latitude":1.5,"longitude":2,"timezone":"UTC",'
        f'"api_retrieval_time":"2026-01-01T06:00:00+00:00","response_time_ms":3.5,"api_response":{GOOD}}}',
        "no json at all",
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    house, _ = load(spark, read_landed(spark, str(tmp_path)))
    stored = house.bronze.read().collect()
    assert json.loads(stored[0].raw_api_response) == json.loads(GOOD)
    assert [e.error_type for e in house.errors.read().collect()] == ["JSONDecodeError"]


def test_read_landed_parquet(spark, tmp_path):
    landed(spark, ("A", T1, GOOD)).write.parquet(str(tmp_path / "p"))
    assert load(spark, read_landed(spark, str(tmp_path / "p"), "parquet"))[1]["stored"] == 1
