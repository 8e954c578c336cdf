"""Event-time parsing, elapsed time and local-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = 1_000_000
_ISO_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def event_time(text: Column, strict: bool = False) -> Column:
    """ISO-8601 text as a timestamp, null where it cannot be read.

    The lenient reading also takes a date or a bare time of day; ``strict`` asks for
    a date and a time.
    """
    parsed = F.try_to_timestamp(text)
    return F.when(text.rlike(_ISO_DATE_TIME), parsed) if strict else parsed


def _whole_units(start: str, end: str, micros: int) -> Column:
    return F.expr(f"(unix_micros(`{end}`) - unix_micros(`{start}`)) div {micros}")


def seconds_between(start: str, end: str) -> Column:
    """Complete seconds from ``start`` to ``end`` (truncated toward zero)."""
    return _whole_units(start, end, _MICROS)


def minutes_between(start: str, end: str) -> Column:
    """Complete minutes from ``start`` to ``end`` (truncated toward zero)."""
    return _whole_units(start, end, 60 * _MICROS)


def local_clock(instant: Column, zone: str) -> Column:
    """Time of day in ``zone`` as HH:mm:ss text."""
    return F.date_format(F.from_utc_timestamp(instant, zone), "HH:mm:ss")
