"""Rows clustered by time and place at once, and read by the files of a range.

A row's cluster key interleaves the bits of two ranks: where its time stands among the quantiles of all times, and where
its name stands among those of all names by their first letters. Neighbours on that curve are close in both, so each file covers a small box, which its
Parquet statistics state. The box of every file is also kept as one small row (a zone map, made by an aggregate
over what was written), so that a range opens only the files that it meets; within them Parquet skips row groups.

Ranks only steer the layout: any ranks give the same rows. NULL times stand in files of any range
without bounds. The zone map is one row for each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions.time import Bound, between_bounds

BITS = 10


def _rank(rows: DataFrame, number: Column) -> Column:
    """Where a number stands among the quantiles of all, of which there are at most 2 ** BITS: a bounded list."""
    parts = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    edges = sorted(set(rows.agg(F.percentile_approx(number, parts, 10_000)).first()[0] or []))
    place = F.size(F.filter(F.lit(edges).cast("array<bigint>"), lambda e: e <= number))
    spread = F.floor(place * ((1 << BITS) - 1) / max(1, len(edges))).cast("int")  # few numbers use all bits too
    return F.when(number.isNotNull(), spread).otherwise(0)


def _letters(column: str) -> Column:
    """The first letters of a name as a number that compares like it."""
    return F.conv(F.hex(F.rpad(F.substring(F.col(column).cast("binary"), 1, 7), 7, F.lit(b"\0"))), 16, 10).cast("long")


def interleaved(a: Column, b: Column) -> Column:
    """The bits of two numbers of BITS bits in turn, those of ``a`` first."""
    parts = [F.shiftleft(F.shiftright(x, k).bitwiseAND(F.lit(1)), 2 * k + top) for k in range(BITS) for x, top in ((a, 1), (b, 0))]
    return sum(parts[1:], parts[0])


def write_clustered(rows: DataFrame, path: str, time: str = "created_at", name: str = "location_name", files: int = 16) -> None:
    """Write ``rows`` as ``files`` files or fewer below ``path``, and their zone map beside them."""
    spark = rows.sparkSession
    key = interleaved(_rank(rows, F.unix_micros(time)), _rank(rows, _letters(name)))
    keyed = rows.withColumn("_cluster", key)
    keyed.repartitionByRange(files, "_cluster").sortWithinPartitions("_cluster").drop("_cluster").write.parquet(f"{path}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    # the path below the folder, so that a folder may be moved
    box = written.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    box.agg(
        F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last"), F.min(name).alias("low"), F.max(name).alias("high")
    ).coalesce(1).write.parquet(f"{path}/zones")


def read_between(
    spark: SparkSession, path: str, schema, start: Bound = None, end: Bound = None, names: list[str] | None = None, time: str = "created_at", name: str = "location_name"
) -> DataFrame:
    """The rows of an inclusive range of time, and of some names, from the files whose box meets it."""
    zones = spark.read.parquet(f"{path}/zones")
    conditions = [between_bounds(F.col("last"), start, None), between_bounds(F.col("first"), None, end)]
    if names is not None:
        conditions.append(F.exists(F.lit(names), lambda x: x.between(F.col("low"), F.col("high"))))
    for condition in conditions:
        zones = zones if condition is None else zones.filter(condition)
    held = sorted(r["file"] for r in zones.select("file").collect())  # names of files
    if not held:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{f}" for f in held])
    within = between_bounds(F.col(time), start, end)
    rows = rows if within is None else rows.filter(within)
    return rows.filter(F.col(name).isin(names)) if names is not None else rows
