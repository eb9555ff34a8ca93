"""Constraints that a Parquet write does not enforce: split rows, or fail in strict mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT = "_reject"  # struct<error_type, error_message>, NULL on valid rows
NO_REJECT = "struct<error_type:string,error_message:string>"


def reason(error_type: str, message: str | Column) -> Column:
    """A reject reason."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(error_type).alias("error_type"), text.alias("error_message"))


def first_reason(rules: list[tuple[Column, Column] | Column]) -> Column:
    """The reason of the first rule whose condition holds, in order; NULL if none does. A rule is
    a condition with its reason, or a column that is a reason or NULL."""
    reasons = [rule if isinstance(rule, Column) else F.when(*rule) for rule in rules]
    return F.coalesce(*reasons, F.lit(None).cast(NO_REJECT))


def not_null(column: str) -> tuple[Column, Column]:
    return F.col(column).isNull(), reason(
        "NotNullViolation", f'null value in column "{column}" violates not-null constraint'
    )


def max_width(column: str, width: int) -> tuple[Column, Column]:
    return F.length(column) > width, reason(
        "StringDataRightTruncation", f"value too long for type character varying({width})"
    )


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT).isNotNull())


def strict(df: DataFrame) -> DataFrame:
    """All or nothing: the first reject fails the job."""
    message = F.concat_ws(": ", F.col(f"{REJECT}.error_type"), F.col(f"{REJECT}.error_message"))
    checked = df.filter(F.when(F.col(REJECT).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))
    return checked.drop(REJECT)
