"""Casts and rounding that agree with SQL numerics rather than with binary doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_numeric(value: Column) -> Column:
    """double -> exact decimal through 15 significant digits.

    A double that is the nearest one to a number of few digits is cast directly: its shortest text is
    that number. All others go through a formatter, which is several times slower. The guard
    matters: ``format_string`` turns NULL into the text 'null'.
    """
    x = value.cast("double")
    exact = F.format_string("%.14e", x).cast("decimal(38,18)")
    return F.when(_few_digits(x), x.cast("decimal(38,18)")).when(x.isNotNull(), exact)


def _few_digits(x: Column) -> Column:
    """At most 14 digits, four of them behind the point."""
    return (F.abs(x) < 1e9) & (F.rint(x * 10_000) / 10_000 == x)


def round_numeric(value: Column, precision: int, scale: int) -> Column:
    """Round half away from zero on the exact decimal; too large a value is an error."""
    return F.round(to_numeric(value), scale).cast(f"decimal({precision},{scale})")


def round_numeric_sql(name: str, precision: int, scale: int) -> str:
    """``round_numeric`` of a double column as SQL text, for projections with many of them."""
    exact = f"CASE WHEN {name} IS NOT NULL THEN cast(format_string('%.14e', {name}) AS decimal(38,18)) END"
    return f"cast(round({exact}, {scale}) AS decimal({precision},{scale}))"


def try_round_numeric(value: Column, precision: int, scale: int) -> Column:
    """As ``round_numeric`` with NULL instead of the error, for guards."""
    exact = F.format_string("%.14e", value.cast("double")).try_cast("decimal(38,18)")
    return F.round(exact, scale).try_cast(f"decimal({precision},{scale})")


def float_to_int(value: Column) -> Column:
    """double -> int to the nearest even, where a plain cast would truncate."""
    return F.rint(value).cast("int")


def numeric_to_int(value: Column) -> Column:
    """Two-decimal number -> int, half away from zero."""
    return F.round(to_numeric(value), 0).cast("int")


def text_to_boolean(value: Column) -> Column:
    """'0.0' and '1.0' flags as boolean, besides the usual boolean words."""
    return F.coalesce(value.try_cast("double") != 0, value.try_cast("boolean"))
