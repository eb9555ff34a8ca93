"""The unique keys of bronze as one Bloom filter for each load and retrieval day.

Filters are plain Parquet by retrieval day, added by Spark's own append before their load is published: a published
load always has its filter, and a load that dies in between leaves bits that only cost a look. So an arriving
batch reads the filters of its own days, and opens those loads alone that may hold one of its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform import schemas as S
from stratiform.operators.membership import filters, possible
from stratiform.sources.tables import FileSystem

DAY = "retrieval_date"
FILTERS = T.StructType([
    T.StructField("load", T.LongType()),
    T.StructField("bits", T.IntegerType()),
    T.StructField("block", T.LongType()),
    T.StructField("bitmap", T.BinaryType()),
    T.StructField(DAY, T.DateType()),
])


class KeyFilters:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, load: int, rows: DataFrame) -> None:
        """Filters of a load that is about to be published; only the key is read."""
        built = filters(rows.select(*S.BRONZE_KEY, DAY), S.BRONZE_KEY, [DAY]).withColumn("load", F.lit(load).cast("long"))
        built.select(*FILTERS.names).write.mode("append").partitionBy(DAY).parquet(self.path)

    def read(self, days: list[str]) -> DataFrame:
        held = [p for d in days if FileSystem(self.spark, self.path).exists(p := f"{self.path}/{DAY}={d}")]
        reader = self.spark.read.schema(FILTERS).option("basePath", self.path)
        return reader.parquet(*held) if held else self.spark.createDataFrame([], FILTERS)

    def loads(self, batch: DataFrame, days: list[str]) -> list[tuple[int, str]]:
        """(load, day) that may hold a key of the batch: names of folders, not data."""
        keys = batch.select(*S.BRONZE_KEY, DAY).distinct()
        found = possible(keys, self.read(days), S.BRONZE_KEY, ["load", DAY], [DAY])
        return sorted((r["load"], str(r[DAY])) for r in found.collect())
