"""Text cleaning: truncation, bytes to text, nested values ready for JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.time import iso_text

MESSAGE_LENGTH = 1000


def truncate_message(message: Column, max_length: int = MESSAGE_LENGTH) -> Column:
    """Messages up to ``max_length`` stay; longer ones are cut and end in '...'."""
    text = message.cast("string")
    return F.when(F.length(text) <= max_length, text).otherwise(
        F.concat(F.substring(text, 1, max_length), F.lit("..."))
    )


def clean_nested(column: Column, dtype: T.DataType) -> Column:
    """bytes -> UTF-8 text and timestamps -> ISO text at any depth of ``dtype``.

    Works on the schema, so a whole document is cleaned in one projection.
    """
    if isinstance(dtype, T.BinaryType):
        return F.decode(column, "UTF-8")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(column, zoned=isinstance(dtype, T.TimestampType))
    if isinstance(dtype, T.ArrayType) and _needs_cleaning(dtype.elementType):
        return F.transform(column, lambda item: clean_nested(item, dtype.elementType))
    if isinstance(dtype, T.MapType) and _needs_cleaning(dtype.valueType):
        return F.transform_values(column, lambda _, item: clean_nested(item, dtype.valueType))
    if isinstance(dtype, T.StructType) and _needs_cleaning(dtype):
        fields = [clean_nested(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def clean_frame(df: DataFrame) -> DataFrame:
    """``clean_nested`` over every column of ``df``."""
    return df.select(*[clean_nested(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def _needs_cleaning(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _needs_cleaning(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _needs_cleaning(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_needs_cleaning(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.BinaryType, T.TimestampType, T.TimestampNTZType))
