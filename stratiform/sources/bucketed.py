"""Rows laid out in buckets of their key, so that an upsert shuffles only the rows that arrive.

Spark's own bucketing: a bucket holds the keys with one hash, sorted. The scan of the stored side then
is already distributed as a join on the key needs it, and so is the result, so that it is written again
bucket by bucket without a shuffle. A folder is written once and never changed; an upsert writes the next one.

The number of buckets belongs to the folder: as many tasks as an upsert is to have. Tables are only a name in the
session's catalog for a folder that all executors share; dropping the name leaves the files.

Defined cases. A key that is hot on the arriving side is reduced to one row before (``first_per_key``); stored keys are
unique. An empty side is joined like any other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(rows: DataFrame, path: str, key: list[str], buckets: int, dealt: bool = False) -> DataFrame:
    """Write ``rows`` to the new folder ``path`` and read them back. ``dealt``: they are distributed by
    the key already, as the result of an upsert is."""
    spark = rows.sparkSession
    if not dealt:
        rows = rows.repartition(buckets, *key)
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows.write.bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(name)
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: list[str], buckets: int) -> DataFrame:
    """A folder that ``write_bucketed`` wrote, perhaps in another session."""
    name, columns = _name(path), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keys = ", ".join(key)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
