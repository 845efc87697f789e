"""Date and time helpers: driver-side run-date checks and column expressions.

Column helpers return ``Column`` objects built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TIME_FORMAT


def parse_run_date(value: str | dt.date) -> dt.date:
    """Strict ``YYYY-MM-DD`` check of a run date, on the driver.

    Raises ``ValueError`` for anything else, so a scheduler sees a failed
    task before a Spark job is started.
    """
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if not isinstance(value, str) or len(value) != 10:
        raise ValueError(f"not a run date (YYYY-MM-DD): {value!r}")
    try:
        return dt.date.fromisoformat(value)
    except ValueError as exc:
        raise ValueError(f"not a run date (YYYY-MM-DD): {value!r}") from exc


def window_start(run_date: str | dt.date, days_back: int = 7) -> dt.date:
    """First date of the closed trailing range ``[run - days_back, run]``."""
    return parse_run_date(run_date) - dt.timedelta(days=days_back)


def parse_time(c: Column | str, fmt: str = TIME_FORMAT) -> Column:
    """Text to timestamp; bad text gives null instead of failing the job."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt))


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return parse_time(c, fmt).cast("date")


def as_timestamp(c: Column | str) -> Column:
    """Any of string / date / timestamp_ntz / timestamp to a session-zone timestamp."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def epoch_millis(c: Column | str) -> Column:
    return F.unix_millis(as_timestamp(c))


def from_epoch_millis(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_millis(c)


def local_date(c: Column | str, zone: str) -> Column:
    """UTC timestamp to the calendar date of ``zone``."""
    return F.to_date(F.from_utc_timestamp(as_timestamp(c), zone))


def compact_date(c: Column | str) -> Column:
    """``2025-03-04`` to ``20250304``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c.cast("string"), "-", "")
