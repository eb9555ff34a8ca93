"""Upserts as joins: conditional, unconditional, insert-or-ignore, insert-or-reject."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.operators.dedup import first_per_key, repeats_per_key
from stratiform.session import moment

ACTION = "_action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"


def conditional_upsert(
    existing: DataFrame, incoming: DataFrame, as_of: Column | dt.datetime | str | None = None
) -> DataFrame:
    """Silver upsert: new keys are inserted; a known key takes the incoming values only if the
    incoming retrieval is strictly newer, and never if the stored retrieval time is NULL.

    ``incoming`` holds one row per key. New rows have a NULL ``id``; the write assigns it.
    """
    now = moment(as_of)
    old = existing.select(F.struct(*S.SILVER.names).alias("o"), *[F.col(k).alias(f"o_{k}") for k in S.SILVER_KEY])
    values = [c for c in S.SILVER.names if c not in ("id", "transformed_at")]
    new = incoming.select(F.struct(*values).alias("n"), *[F.col(k).alias(f"n_{k}") for k in S.SILVER_KEY])
    same_key = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in S.SILVER_KEY]
    joined = old.join(new, same_key, "full_outer")

    flagged = joined.select(
        "o",
        "n",
        now.alias("_now"),
        F.expr("o_location_name IS NULL AS _insert"),
        F.expr("coalesce(n.api_retrieval_time > o.api_retrieval_time, false) AS _newer"),
    )
    columns = []
    for name in S.SILVER.names:
        if name == "id":
            columns.append("o.id AS id")
        elif name == "transformed_at":
            columns.append("IF(_insert OR _newer, _now, o.transformed_at) AS transformed_at")
        elif name in S.SILVER_REPLACED:
            columns.append(f"IF(_insert OR _newer, n.{name}, o.{name}) AS {name}")
        else:
            columns.append(f"IF(_insert, n.{name}, o.{name}) AS {name}")
    action = f"CASE WHEN _insert THEN '{INSERT}' WHEN _newer THEN '{UPDATE}' ELSE '{KEEP}' END AS {ACTION}"
    return flagged.selectExpr(*columns, action)


def replacing_upsert(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Gold upsert: incoming rows replace rows of the same key; all other rows stay."""
    names = existing.columns
    old = existing.select(F.struct(*names).alias("o"), *[F.col(k).alias(f"o_{k}") for k in key])
    new = incoming.select(F.struct(*names).alias("n"), *[F.col(k).alias(f"n_{k}") for k in key])
    joined = old.join(new, [F.col(f"o_{k}") == F.col(f"n_{k}") for k in key], "full_outer")
    columns = [f"IF(n_{key[0]} IS NOT NULL, n.{c}, o.{c}) AS {c}" for c in names]
    action = f"CASE WHEN n_{key[0]} IS NULL THEN '{KEEP}' WHEN o_{key[0]} IS NULL THEN '{INSERT}' ELSE '{UPDATE}' END"
    return joined.selectExpr(*columns, f"{action} AS {ACTION}")


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Rows that ON CONFLICT DO NOTHING would add: the first of each new key."""
    return first_per_key(incoming, key, order).join(existing.select(*key), key, "left_anti")


def insert_or_reject(
    existing: DataFrame, incoming: DataFrame, key: list[str], order: list[str], slim: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Insert under a unique key -> (accepted rows, refused rows reduced to ``slim`` columns).

    Refused rows leave the wide columns behind before any shuffle.
    """
    known = existing.select(*key)
    ordering = [F.col(c) for c in order]
    accepted = first_per_key(incoming, key, ordering).join(known, key, "left_anti")
    narrow = incoming.select(*dict.fromkeys([*key, *order, *slim]))
    repeats = repeats_per_key(narrow, key, ordering).select(*slim)
    taken = first_per_key(narrow, key, ordering).join(known, key, "left_semi").select(*slim)
    return accepted, repeats.unionByName(taken)
