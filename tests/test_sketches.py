"""Sketches and states that merge: value ranges, payload types, overlaps of keys."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from stratiform.plans import sketches as K
from stratiform.plans.quality import range_checks

VALUES = ["temperature_2m_celsius", "uv_index"]


@pytest.fixture(scope="module")
def values(spark):
    r = random.Random(5)
    rows = [(k % 3, r.gauss(10, 4), None if k % 7 == 0 else float(k % 12)) for k in range(6000)]
    rows += [(0, math.nan, math.inf), (1, None, None)]
    return spark.createDataFrame(rows, f"load long, {VALUES[0]} double, {VALUES[1]} double")


def test_merged_sketches_keep_their_error(values):
    ranks = [0.0, 0.05, 0.5, 0.95, 1.0]
    merged = K.merged_sketches(K.value_sketches(values, ["load"], VALUES))
    found = {(r.variable, r.rank): (r["values"], r.value) for r in K.quantiles(merged, ranks).collect()}
    for c in VALUES:
        exact = sorted(r[0] for r in values.select(c).collect() if r[0] is not None and math.isfinite(r[0]))
        for rank in ranks:
            n, value = found[c, rank]
            assert n == len(exact)
            below, up = sum(x < value for x in exact) / n, sum(x <= value for x in exact) / n
            assert below <= rank + K.RANK_ERROR and up >= rank - K.RANK_ERROR


def test_ranges_are_learned_and_used(spark, values):
    ranges = K.learned_ranges(K.value_sketches(values, None, VALUES))
    assert set(ranges) == set(VALUES) and -20 < ranges[VALUES[0]][0] < 0 < 20 < ranges[VALUES[0]][1] < 45
    odd = spark.createDataFrame([(500.0, 5.0), (9.0, None), (-500.0, 6.0)], f"{VALUES[0]} double, {VALUES[1]} double")
    rows = {r.column_name: tuple(r)[1:] for r in range_checks(odd, ranges).collect()}
    assert rows[VALUES[0]] == (3, 1, 1) and rows[VALUES[1]] == (2, 0, 0)
    assert K.value_sketches(values.limit(0), ["load"], VALUES).count() == 0


def types(df):
    return {r.path: (r.type, r.documents, r.missing) for r in df.collect()}


def documents(spark, *texts):
    rows = [(i % 2, t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "load long, raw_api_response string")


def test_types_join_over_documents(spark):
    docs = documents(
        spark,
        {"a": 1, "b": "x", "hourly": {"t": ["x"], "v": [1, None], "w": [], "m": [1, "x"], "n": None}},
        {"a": 2.5, "b": 3, "hourly": {"t": ["y"], "v": [2.5], "w": [True], "m": 7}},
        {"a": None, "c": {"d": 1}, "hourly": [1]},
        "not json", None, "[1]", "7",
    )
    expected = {
        "a": ("number", 3, 0), "b": ("variant", 2, 1), "c": ("object", 1, 2), "hourly": ("variant", 3, 0),
        "hourly.t": ("array<string>", 2, 1), "hourly.v": ("array<number>", 2, 1), "hourly.w": ("array<boolean>", 2, 1),
        "hourly.m": ("variant", 2, 1), "hourly.n": ("null", 1, 2),
    }
    assert types(K.payload_types(K.payload_kinds(docs))) == expected
    by_load = K.payload_kinds(docs, by=["load"])
    assert types(K.payload_types(K.merged_kinds(by_load))) == expected
    each = K.payload_types(by_load, ["load"])
    assert {(r.load, r.path, r.type) for r in each.filter("path = 'b'").collect()} == {(0, "b", "string"), (1, "b", "number")}
    assert K.payload_types(K.payload_kinds(docs.limit(0))).count() == 0


def test_empty_arrays_and_drift(spark):
    before = K.payload_types(K.payload_kinds(documents(spark, {"hourly": {"x": [], "y": [1], "z": [None]}})))
    assert types(before) == {"hourly": ("object", 1, 0), "hourly.x": ("array<nothing>", 1, 0), "hourly.y": ("array<number>", 1, 0), "hourly.z": ("array<null>", 1, 0)}
    after = K.payload_types(K.payload_kinds(documents(spark, {"hourly": {"x": [], "y": ["1"]}, "more": 1})))
    found = {tuple(r) for r in K.drift(before, after).collect()}
    assert found == {
        ("hourly.y", "changed", "array<number>", "array<string>"),
        ("hourly.z", "gone", "array<null>", None),
        ("more", "new", None, "number"),
    }


def keys(spark, day, start, end):
    return spark.range(start, end).select(F.lit(day).alias("day"), F.col("id").alias("k"), F.col("id").cast("string").alias("name"))


def test_overlap_is_exact_for_small_groups_and_close_for_large_ones(spark, monkeypatch):
    stored = keys(spark, "a", 0, 100).unionByName(keys(spark, "b", 0, 50)).unionByName(keys(spark, "big", 0, 60_000))
    arriving = keys(spark, "a", 90, 120).unionByName(keys(spark, "b", 70, 80)).unionByName(keys(spark, "c", 0, 5)).unionByName(keys(spark, "big", 30_000, 90_000))
    held, fresh = (K.key_sketches(x, ["k", "name"], ["day"]) for x in (stored, arriving))
    rows = {r.day: tuple(r)[1:] for r in K.overlap(held, fresh, ["day"]).collect()}
    big = rows.pop("big")
    assert rows == {"a": (100, 30, 10, "merge"), "b": (50, 10, 0, "append"), "c": (0, 5, 0, "new")}
    assert big[3] == "merge" and all(abs(got / exact - 1) < 0.05 for got, exact in zip(big, (60_000, 60_000, 30_000), strict=False))
    # large groups without a common key are merged: a sketch can't be sure
    apart = keys(spark, "big", 10**6, 10**6 + 20_000)
    (row,) = K.overlap(held, K.key_sketches(apart, ["k", "name"], ["day"]), ["day"]).collect()
    assert row.common == 0 and row.action == "merge"
    nulls = apart.withColumn("k", F.lit(None).cast("long"))
    assert K.key_sketches(nulls, ["k", "name"], ["day"]).count() == 0
