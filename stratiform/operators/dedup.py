"""One row per key, and the rows that lose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in ``order``.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit), so a key
    that holds a third of all rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame) -> DataFrame:
    """Per location and hour the values of the latest retrieval; NULL times sort first."""
    return first_per_key(
        df,
        ["location_name", "observation_timestamp"],
        [F.desc_nulls_first("api_retrieval_time"), F.desc("bronze_record_id")],
    )


def repeats_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The complement of ``first_per_key``: every row of a key but its first.

    The first place of each key is a minimum, taken before the shuffle, and the join back can be
    split where a key is hot. Rows that tie for the first place are told apart by their number.
    """
    place = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    rows = df.withColumn("_place", place)
    firsts = rows.groupBy(*key).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows")).filter("_rows > 1")
    met = rows.join(firsts.drop("_rows"), key)
    later = met.filter("_place > _first")
    ties = met.filter("_place = _first")
    again = ties.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy("_place"))).filter("_nth > 1").drop("_nth")
    return later.unionByName(again).drop("_place", "_first")
