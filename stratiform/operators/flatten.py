"""Parallel arrays -> rows."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _zip(arrays: Mapping[str, Column]) -> Column:
    # arrays_zip names its fields after the inputs, so the inputs become plain columns first
    return F.expr(f"arrays_zip({', '.join(f'_a_{name}' for name in arrays)})")


def zip_longest(df: DataFrame, keep: list[Column], arrays: Mapping[str, Column]) -> DataFrame:
    """Zip by position and pad shorter arrays with NULL; a row without items disappears."""
    staged = df.select(*keep, *[a.alias(f"_a_{n}") for n, a in arrays.items()])
    rows = staged.select("*", F.explode(_zip(arrays)).alias("_item"))
    kept = [c for c in staged.columns if not c.startswith("_a_")]
    return rows.selectExpr(*kept, *[f"_item._a_{n} AS {n}" for n in arrays])


def zip_shortest(df: DataFrame, keep: list[Column], arrays: Mapping[str, Column], ordinal: str) -> DataFrame:
    """Inner join of the arrays on their ordinal, without a join: zip and stop at the shortest."""
    staged = df.select(*keep, *[a.alias(f"_a_{n}") for n, a in arrays.items()])
    sizes = [F.size(f"_a_{n}") for n in arrays]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    rows = staged.select("*", F.explode(F.slice(_with_position(arrays), F.lit(1), shortest)).alias("_item"))
    kept = [c for c in staged.columns if not c.startswith("_a_")]
    return rows.selectExpr(*kept, f"_item.pos AS {ordinal}", *[f"_item.item._a_{n} AS {n}" for n in arrays])


def _with_position(arrays: Mapping[str, Column]) -> Column:
    return F.transform(_zip(arrays), lambda item, pos: F.struct((pos + 1).alias("pos"), item.alias("item")))


def with_ordinality(df: DataFrame, keep: list[Column], array: Column, value: str, ordinal: str) -> DataFrame:
    """Array items with their 1-based position."""
    rows = df.select(*keep, F.posexplode(array).alias("_pos", value))
    return rows.withColumn(ordinal, F.col("_pos") + 1).drop("_pos")


def ordinality_join(df: DataFrame, key: str, arrays: Mapping[str, Column], ordinal: str = "ordinal") -> DataFrame:
    """The join spelled out: every array becomes (key, ordinal, value) rows, joined one by one.

    All joins share one key, so Spark shuffles each side once. ``zip_shortest`` gives the same
    rows without any shuffle; this form is its cross-check.
    """
    sides = [with_ordinality(df, [F.col(key)], a, n, ordinal) for n, a in arrays.items()]
    return functools.reduce(lambda left, right: left.join(right, [key, ordinal]), sides)


def lateral_elements(spark: SparkSession, df: DataFrame, keep: list[str], array: str, value: str, ordinal: str) -> DataFrame:
    """CROSS JOIN LATERAL over the items of ``array`` with their 1-based position."""
    items = spark.tvf.posexplode(F.col(array).outer()).toDF("_pos", value)
    return df.lateralJoin(items).select(*keep, (F.col("_pos") + 1).alias(ordinal), value)
