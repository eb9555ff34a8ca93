"""Landed responses and typed hourly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform import schemas as S
from stratiform.functions.documents import CORRUPT
from stratiform.functions.time import time_axis
from stratiform.operators.flatten import zip_longest


def read_landed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """One row per response: JSON lines (``api_response`` as object or text) or Parquet.

    A line that is no JSON keeps its text in the corrupt column and is rejected by the load.
    """
    if fmt == "parquet":
        return spark.read.schema(S.LANDED).parquet(path).withColumn(CORRUPT, F.lit(None).cast("string"))
    schema = T.StructType([*S.LANDED.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def hourly_frame(
    series: DataFrame, start: Column, end: Column, step: Column, names: list[str], values: Column, keep: list[str]
) -> DataFrame:
    """Columnar series -> rows (date_utc, one column per variable).

    ``values`` holds the series in the order of ``names``: the i-th series gets the i-th name.
    Positions past the end of a series are NULL; positions past the time axis are no rows.
    """
    axis = time_axis(start, end, step)
    # cut to the axis and zipped with it before the rows are made, so that no row rebuilds an array
    staged = series.select(*keep, values.alias("_values"), axis.alias("_axis"))
    arrays = {name: F.slice(F.coalesce(F.get("_values", F.lit(i)), F.array()), F.lit(1), F.size("_axis")) for i, name in enumerate(names)}
    rows = zip_longest(staged, [F.col(k) for k in keep], {"date_utc": F.col("_axis"), **arrays})
    return rows.select(*keep, "date_utc", *[F.col(name).cast("double").alias(name) for name in names])
