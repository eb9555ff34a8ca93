"""Membership filters never miss a key, and keep loads without common keys closed."""

from __future__ import annotations

import pytest
from conftest import bronze, hours, landed, payload
from pyspark.sql import functions as F

from stratiform.operators import membership
from stratiform.operators.membership import filters, possible
from stratiform.plans.warehouse import Warehouse
from stratiform.session import scratch_dir

KEY, DAY = ["name", "at"], "day"


def keys(spark, start, end, day="d"):
    return spark.range(start, end).select(F.concat(F.lit("k"), F.col("id")).alias("name"), F.col("id").alias("at"), F.lit(day).alias(DAY))


@pytest.mark.parametrize("size", [1, 40, 2000])
def test_no_key_is_missed_and_few_others_are_met(spark, monkeypatch, size):
    monkeypatch.setattr(membership, "KEYS", 300)
    rows = keys(spark, 0, 3 * size).withColumn("load", F.pmod("at", F.lit(3)))
    held = filters(rows, KEY, ["load", DAY]).cache()
    for load in range(3):
        for k in (load, 3 * (size // 2) + load):
            found = possible(keys(spark, k, k + 1), held, KEY, ["load"], [DAY])
            assert load in {r.load for r in found.collect()}
    others = possible(keys(spark, 10**6, 10**6 + 500).withColumn("number", F.col("at")), held, KEY, ["load", "bits"], [DAY])
    assert others.count() <= 3
    apart = [possible(keys(spark, 10**6 + i, 10**6 + i + 1), held, KEY, ["load"], [DAY]).count() for i in range(8)]
    assert sum(apart) <= 2
    assert possible(keys(spark, 0, 5, "other day"), held, KEY, ["load"], [DAY]).count() == 0
    held.unpersist()


def test_null_keys_and_empty_sides(spark):
    rows = spark.createDataFrame([("A", None, "d", 1), (None, 2, "d", 1), ("A", 2, "d", 1), ("A", 2, "d", 1)], "name string, at long, day string, load long")
    held = filters(rows, KEY, ["load", DAY])
    assert held.select(F.sum(F.bitmap_count("bitmap"))).first()[0] <= membership.HASHES
    assert possible(rows.filter("at IS NULL"), held, KEY, ["load"], [DAY]).count() == 0
    assert possible(rows.limit(0), held, KEY, ["load"], [DAY]).count() == 0
    assert possible(rows, held.limit(0), KEY, ["load"], [DAY]).count() == 0


def documents(spark, names, minute):
    return landed(spark, *[(n, f"2026-01-01T06:{minute:02d}:00", payload(hours(0), rain=[1.0])) for n in names])


def test_loads_without_common_keys_stay_closed(spark):
    house = Warehouse(spark, scratch_dir(spark, "filters"))
    for i in range(4):
        house.load_landed(documents(spark, [f"P{i}", f"Q{i}"], i))
    assert house.bronze.read().count() == 8
    again = bronze(spark, (1, "Q2", "2026-01-01T06:02:00", "{}"), (2, "new", "2026-01-01T06:09:00", "{}"))
    opened = house._known(again, ["2026-01-01"]).inputFiles()
    loads = {f.split("load=")[1].split("/")[0] for f in opened}
    assert len(loads) == 1
    assert {r.location_name for r in house._known(again, ["2026-01-01"]).collect()} == {"P2", "Q2"}
    assert not house._known(again.filter("location_name = 'new'"), ["2026-01-01"]).inputFiles()
    # the exact join decides: a known key is refused, a new one is not
    result = house.load_landed(documents(spark, ["Q2", "new"], 2))
    assert (result["stored"], result["refused"]) == (1, 1)


def test_a_load_that_died_leaves_only_its_filter(spark, monkeypatch):
    house = Warehouse(spark, scratch_dir(spark, "filters"))
    publish = house.bronze.publish
    monkeypatch.setattr(house.bronze, "publish", lambda staged: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        house.load_landed(documents(spark, ["A"], 1))
    monkeypatch.setattr(house.bronze, "publish", publish)
    assert house.load_landed(documents(spark, ["A", "B"], 1))["stored"] == 2
    assert house.load_landed(documents(spark, ["A", "C"], 1))["stored"] == 1
