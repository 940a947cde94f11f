"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweb.functions.draws import uniform


def from_step(step: str | Column, unit_seconds: int = 1) -> Column:
    """Integer clock → timestamp."""
    return F.timestamp_seconds((F.col(step) if isinstance(step, str) else step) * F.lit(unit_seconds))


def shift_days(ts: str | Column, days: Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts) + F.make_dt_interval(days.cast("int"))


def jitter(ts: Column, seconds: int, salt: str, *key: str | Column) -> Column:
    """Move a timestamp forward by a whole number of seconds in [0, seconds)."""
    return F.timestamp_seconds(F.unix_timestamp(ts) + (uniform(salt, *key) * seconds).cast("int"))


def iso(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def combine(date: str | Column, time_text: str | Column) -> Column:
    """A date and an `HH:mm[:ss]` text → timestamp; NULL where they do not parse."""
    return F.try_to_timestamp(F.concat_ws(" ", F.date_format(date, "yyyy-MM-dd"), time_text))


def wall_clock(ts: str | Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")
