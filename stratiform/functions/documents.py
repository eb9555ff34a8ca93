"""JSON documents with parallel hourly arrays: validity, paths, keys, arrays, building."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.time import iso_text

CORRUPT = "_corrupt"
TEXT_ARRAY = "array<string>"


def is_valid_json(raw: Column) -> Column:
    """Strict JSON; NaN and other non-standard numbers are invalid."""
    return F.try_parse_json(raw).isNotNull()


def payload_schema(variables: Iterable[str], numbers: Iterable[str] = ()) -> T.StructType:
    """Only the fields a job needs: the parser skips all others. ``numbers`` become doubles."""
    numbers = set(numbers)

    def typed(name: str) -> T.DataType:
        return T.DoubleType() if name in numbers else T.StringType()

    arrays = [T.StructField(name, T.ArrayType(typed(name))) for name in ("time", *variables)]
    return T.StructType([
        T.StructField("latitude", typed("latitude")),
        T.StructField("longitude", typed("longitude")),
        T.StructField("timezone", T.StringType()),
        T.StructField("hourly", T.StructType(arrays)),
        T.StructField(CORRUPT, T.StringType()),
    ])


def parse_payload(raw: Column, variables: Iterable[str], numbers: Iterable[str] = ()) -> Column:
    """View of a document. Text items keep their form ('3.0'); a field of the wrong shape shows in
    the corrupt column instead of being dropped silently."""
    return F.from_json(raw, payload_schema(variables, numbers), {"columnNameOfCorruptRecord": CORRUPT})


def text_array(value: Column) -> Column:
    """A missing array is an empty one; ``arrays_zip`` would drop the document on NULL."""
    return F.coalesce(value, F.array().cast(TEXT_ARRAY))


def object_path(raw: Column, *path: str) -> Column:
    """Part of a document as JSON text."""
    return F.get_json_object(raw, "$" + "".join(f"['{p}']" for p in path))


def object_keys(raw: Column, *path: str) -> Column:
    """Keys of the object at ``path``."""
    return F.json_object_keys(object_path(raw, *path) if path else raw)


def element_array(raw: Column, *path: str) -> Column:
    """The JSON array at ``path`` as an array of text items."""
    return text_array(F.from_json(object_path(raw, *path), T.ArrayType(T.StringType())))


def first_element(value: Column) -> Column:
    """First item of a JSON array, or the scalar itself."""
    items = F.from_json(value, T.ArrayType(T.StringType()), {"mode": "PERMISSIVE"})
    return F.when(F.json_array_length(value).isNotNull(), F.try_element_at(items, F.lit(1))).otherwise(value)


def named_series(names: Column, series: Column) -> Column:
    """The i-th series under the i-th requested name."""
    return F.map_from_arrays(names, series)


def series_document(axis: Column, names: list[str], series: Column, scalars: Mapping[str, Column]) -> Column:
    """A columnar response as a JSON document: the time axis, and the i-th series under the i-th name."""
    arrays = [F.get(series, F.lit(i)).alias(name) for i, name in enumerate(names)]
    hourly = F.struct(F.transform(axis, lambda t: iso_text(t)).alias("time"), *arrays)
    return F.to_json(F.struct(*[c.alias(n) for n, c in scalars.items()], hourly.alias("hourly")))


def build_documents(
    hours: DataFrame, key: list[str], time_column: str, variables: Mapping[str, Column], scalars: Mapping[str, Column]
) -> DataFrame:
    """Hourly rows -> one document per ``key``: scalars plus parallel arrays ordered by time.

    ``key`` has to bound the hours of a document (a forecast horizon, a week): the items of one
    document meet in one task. ``scalars`` are aggregates over the group.
    """
    items = F.array_sort(
        F.collect_list(F.struct(F.col(time_column).alias("time"), *[c.alias(n) for n, c in variables.items()]))
    )
    grouped = hours.groupBy(*key).agg(items.alias("_items"), *[c.alias(f"_s_{n}") for n, c in scalars.items()])
    arrays = [F.transform(F.col("_items.time"), lambda t: iso_text(t)).alias("time")]
    arrays += [F.col(f"_items.{name}").alias(name) for name in variables]
    document = F.to_json(F.struct(*[F.col(f"_s_{n}").alias(n) for n in scalars], F.struct(*arrays).alias("hourly")))
    return grouped.select(*key, *[F.col(f"_s_{n}").alias(n) for n in scalars], document.alias("api_response"))
