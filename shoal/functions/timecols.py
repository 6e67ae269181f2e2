"""Time expressions kept in whole microseconds so results are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def floor_to(ts: Column, step_minutes: int) -> Column:
    """Floor a timestamp to the epoch-aligned grid of ``step_minutes`` (the grid
    ``window()`` uses for its window starts)."""
    step = step_minutes * MICROS_PER_MINUTE
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(step)))


def add_minutes(ts: Column, minutes: int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(minutes * MICROS_PER_MINUTE))


def seconds_between(later: Column, earlier: Column) -> Column:
    """``later - earlier`` in seconds as DOUBLE (Spark has no EXTRACT(EPOCH))."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def minute_bucket(ts: Column) -> Column:
    return F.date_trunc("minute", ts)
