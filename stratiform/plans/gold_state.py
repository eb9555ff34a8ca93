"""Daily summaries kept up to date from the hours that change, without reading the others.

For each day and place a state row holds what the summary is made of: exact decimal sums, counts of values, extremes
and a histogram of codes. Sums, counts and histograms take a replaced hour back exactly. An extreme can't be taken
back: where the hour that goes held it and no new one reaches it, that day and place alone is looked up in silver.

States merge: the state of all hours is that of any split of them, whatever the order.

Defined cases. A NULL value counts nowhere; a variable without values has NULL in its summary. Hours that are
replaced may change any value to or from NULL. Values that are no finite numbers fit no decimal and fail, as
they do in ``to_gold``. A day and place without changes keeps its row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform import schemas as S
from stratiform.functions.numeric import float_to_int, round_numeric_sql
from stratiform.session import moment

DAY = "observation_date"
KEY = [DAY, "location_name"]
_SUMMED = list(dict.fromkeys([*(m.source for m in S.MEASURES if m.aggregate in ("sum", "avg")), "is_day"]))
_LEAST = [m.source for m in S.MEASURES if m.aggregate == "min"]
_MOST = [m.source for m in S.MEASURES if m.aggregate == "max"]
_CODE = "weather_code"
#: Columns of silver that a state is made of.
VALUES = list(dict.fromkeys([*_SUMMED, *_LEAST, *_MOST, _CODE]))
_EXACT = "decimal(38,15)"


def changes(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The hours that a conditional upsert of ``incoming`` changes, with their values before and after.

    (location_name, observation_timestamp, observation_date, o, n): ``o`` is NULL for a new hour.
    """
    old = existing.select(*[F.col(k).alias(f"_{k}") for k in S.SILVER_KEY], F.col("api_retrieval_time").alias("_held"), F.struct(*VALUES).alias("o"))
    met = incoming.join(old, [F.col(k) == F.col(f"_{k}") for k in S.SILVER_KEY], "left")
    changed = F.col("_location_name").isNull() | (F.col("api_retrieval_time") > F.col("_held"))
    return met.filter(changed).select(*S.SILVER_KEY, DAY, "o", F.struct(*VALUES).alias("n"))


def _folded(rows: DataFrame) -> DataFrame:
    """State rows of (day, place, sign, values): sign -1 takes an hour back.

    Extremes are those of the hours that come (n_) and of those that go (o_).
    """
    sign = F.col("_sign")
    signed = [F.sum(sign * F.col(c).cast(_EXACT)).cast(_EXACT).alias(f"sum_{c}") for c in _SUMMED]
    counts = [F.sum(F.when(F.col(c).isNotNull(), sign)).alias(f"n_{c}") for c in _SUMMED]
    least = [F.min(F.when(sign == k, F.col(c))).alias(f"{p}min_{c}") for c in _LEAST for k, p in ((1, ""), (-1, "gone_"))]
    most = [F.max(F.when(sign == k, F.col(c))).alias(f"{p}max_{c}") for c in _MOST for k, p in ((1, ""), (-1, "gone_"))]
    # a code has a row of its own, so that histograms are counted before the shuffle
    by_code = rows.groupBy(*KEY, _CODE).agg(F.sum(sign).alias("_rows"), *signed, *counts, *least, *most)
    merged = by_code.groupBy(*KEY).agg(
        F.sum("_rows").alias("records"),
        *[F.sum(f"{p}_{c}").cast(_EXACT if p == "sum" else "long").alias(f"{p}_{c}") for c in _SUMMED for p in ("sum", "n")],
        *[F.min(f"{p}min_{c}").alias(f"{p}min_{c}") for c in _LEAST for p in ("", "gone_")],
        *[F.max(f"{p}max_{c}").alias(f"{p}max_{c}") for c in _MOST for p in ("", "gone_")],
        F.map_from_entries(F.collect_list(F.when(F.col(_CODE).isNotNull(), F.struct(_CODE, "_rows")))).alias("codes"),
    )
    zero = {f"n_{c}": F.coalesce(f"n_{c}", F.lit(0)) for c in _SUMMED}
    zero |= {f"sum_{c}": F.coalesce(f"sum_{c}", F.lit(0).cast(_EXACT)) for c in _SUMMED}
    return merged.withColumns(zero)


def state_of(silver: DataFrame) -> DataFrame:
    """The state of all days and places of ``silver``."""
    rows = silver.filter(F.col("observation_timestamp").isNotNull()).select(
        F.to_date("observation_timestamp").alias(DAY), "location_name", F.lit(1).cast("long").alias("_sign"), *VALUES
    )
    return _folded(rows).drop(*[f"gone_min_{c}" for c in _LEAST], *[f"gone_max_{c}" for c in _MOST])


def delta_of(changed: DataFrame) -> DataFrame:
    """What changed hours add to the state of their days and places, and take from it."""
    sides = F.array(
        F.struct(F.lit(1).cast("long").alias("_sign"), F.col("n").alias("_v")), F.struct(F.lit(-1).cast("long").alias("_sign"), F.col("o").alias("_v"))
    )
    rows = changed.select(F.to_date("observation_timestamp").alias(DAY), "location_name", F.inline(sides)).filter("_v IS NOT NULL")
    return _folded(rows.select(*KEY, "_sign", "_v.*"))


def merge(state: DataFrame, delta: DataFrame) -> DataFrame:
    """``state`` after the changes, with ``_lost``: an extreme has gone, so the row has to be looked up."""
    d = delta.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.struct(*[c for c in delta.columns if c not in KEY]).alias("d"))
    met = state.join(d, [F.col(k) == F.col(f"_{k}") for k in KEY], "full_outer")
    columns = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in KEY]
    columns.append((F.coalesce("records", F.lit(0)) + F.coalesce("d.records", F.lit(0))).alias("records"))
    for c in _SUMMED:
        columns += [(F.coalesce(f"{p}_{c}", F.lit(0)) + F.coalesce(f"d.{p}_{c}", F.lit(0))).cast(_EXACT if p == "sum" else "long").alias(f"{p}_{c}") for p in ("sum", "n")]
    lost = F.lit(False)
    for kind, names, better in (("min", _LEAST, F.least), ("max", _MOST, F.greatest)):
        for c in names:
            held, new, gone = F.col(f"{kind}_{c}"), F.col(f"d.{kind}_{c}"), F.col(f"d.gone_{kind}_{c}")
            columns.append(better(held, new).alias(f"{kind}_{c}"))
            reached = better(held, new) == new
            lost = lost | F.coalesce((gone == held) & ~F.coalesce(reached, F.lit(False)), F.lit(False))
    none = F.create_map().cast("map<string,bigint>")
    both = F.map_zip_with(F.coalesce("codes", none), F.coalesce("d.codes", none), lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    columns.append(F.map_filter(both, lambda _, n: n > 0).alias("codes"))
    return met.select(*columns, lost.alias("_lost"), F.col("d").isNotNull().alias("_touched"))


def updated(state: DataFrame, changed: DataFrame, silver: DataFrame) -> DataFrame:
    """The state after ``changed``, with ``_touched`` for the rows that are new. ``silver`` holds the changes already; only
    the days and places whose extreme has gone are looked up there."""
    merged = merge(state, delta_of(changed))
    lost = merged.filter("_lost").select(*KEY)
    again = state_of(silver.join(lost, KEY, "left_semi")).withColumn("_touched", F.lit(True))
    return merged.filter("NOT _lost").drop("_lost").unionByName(again)


def gold_of(state: DataFrame, as_of: Column | dt.datetime | str | None = None) -> DataFrame:
    """The daily summaries of the states, in the columns of gold."""
    raw = []
    for m in S.MEASURES:
        known, total = F.col(f"n_{m.source}") if m.source in _SUMMED else None, F.col(f"sum_{m.source}") if m.source in _SUMMED else None
        if m.aggregate == "sum":
            value = F.when(known > 0, total.cast("double"))
        elif m.aggregate == "avg":
            value = F.when(known > 0, total.cast("double") / known)
        else:
            value = F.col(f"{m.aggregate}_{m.source}")
        raw.append(value.alias(m.column))
    # most often, then the smallest text
    best = F.array_sort(F.transform(F.map_entries("codes"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("code"))))
    rows = state.select(
        *KEY,
        *raw,
        F.when(F.col("n_is_day") > 0, F.col("sum_is_day").cast("double")).alias("_daylight"),
        F.get(best, F.lit(0))["code"].alias("dominant_weather_code"),
        "records",
    )
    return rows.select(
        "location_name",
        *[F.expr(f"{round_numeric_sql(m.column, m.precision, m.scale)} AS {m.column}") for m in S.MEASURES],
        float_to_int(F.col("_daylight")).alias("daylight_hours"),
        "dominant_weather_code",
        F.col("records").cast("int").alias("record_count"),
        moment(as_of).alias("created_at"),
        DAY,
    )
