"""Time axis, ISO text, elapsed time and date bounds."""

from __future__ import annotations

import datetime as dt
import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

Bound = str | dt.datetime | None


def time_axis(start_epoch: Column, end_epoch: Column, step_seconds: Column) -> Column:
    """UTC timestamps of the half-open range [start, end); empty when start >= end."""
    seconds = F.sequence(start_epoch, end_epoch - 1, step_seconds.cast("long"))
    axis = F.transform(seconds, F.timestamp_seconds)
    return F.when(start_epoch < end_epoch, axis).otherwise(F.array().cast("array<timestamp>"))


def iso_text(ts: Column, zoned: bool = True) -> Column:
    """ISO-8601 text; microseconds appear only when there are any."""
    offset = "xxx" if zoned else ""
    whole = F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss{offset}")
    exact = F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{offset}")
    return F.when(ts == F.date_trunc("second", ts), whole).otherwise(exact)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds from ``start`` to ``end`` with two decimals, half up on whole microseconds."""
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1000, 2)


def age(as_of: Column, ts: Column) -> Column:
    """as_of - ts as a day-time interval."""
    return as_of - ts


def within_hours(ts: Column, as_of: Column, hours: int) -> Column:
    """Strictly newer than ``hours`` before ``as_of``."""
    return ts > as_of - F.expr(f"INTERVAL {int(hours)} HOURS")


def _bound(value: str | dt.datetime) -> Column:
    text = value.isoformat() if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp")


def utc_day(value: str | dt.datetime) -> str:
    """The ISO day of a bound in UTC."""
    at = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(value)
    return (at.astimezone(dt.timezone.utc) if at.tzinfo else at).date().isoformat()


def between_bounds(ts: Column, start: Bound = None, end: Bound = None) -> Column | None:
    """Inclusive range; an empty bound is no bound, and None means no filter at all."""
    return _within(ts, *(_bound(b) if b else None for b in (start, end)))


def date_between_bounds(day: Column, start: Bound = None, end: Bound = None) -> Column | None:
    """Whole UTC days touched by the range, so that bounds never cut through a day."""
    return _within(day, *(F.to_date(_bound(b)) if b else None for b in (start, end)))


def _within(value: Column, least: Column | None, most: Column | None) -> Column | None:
    conditions = [value >= least] if least is not None else []
    conditions += [value <= most] if most is not None else []
    return functools.reduce(operator.and_, conditions) if conditions else None


def backfill_mode(start: Bound = None, end: Bound = None) -> str:
    """What a backfill covers: all, from, until or between."""
    return {(False, False): "all", (True, False): "from", (False, True): "until", (True, True): "between"}[bool(start), bool(end)]
