"""Conversions between epoch numbers, timestamps and text (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(text: Column) -> Column:
    """Epoch seconds as text or number to a timestamp; null if not a number."""
    return F.timestamp_seconds(text.try_cast("long"))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def to_text(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    return F.date_format(ts, pattern)


def micros(duration: str) -> int:
    """Length of a duration such as ``"5 seconds"`` or ``"1 hour"``."""
    units = {
        "microsecond": 1,
        "millisecond": 1_000,
        "second": 1_000_000,
        "minute": 60_000_000,
        "hour": 3_600_000_000,
        "day": 86_400_000_000,
    }
    number, unit = duration.split()
    return int(number) * units[unit.rstrip("s")]


def floor_to(us: Column, width: int) -> Column:
    """The last multiple of ``width`` that is not after a time in microseconds."""
    return us - F.pmod(us, F.lit(width))


def us_to_ms(us: Column) -> Column:
    """Microseconds to milliseconds, rounding down, without leaving longs."""
    return ((us - F.pmod(us, F.lit(1000))) / 1000).cast("long")
