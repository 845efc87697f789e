"""Row filters.  All are plain ``where`` calls so Catalyst can push them to the
scan (data filters) or prune partitions (filters on the partition column)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_run_date


def on_date(df: DataFrame, day: str | dt.date, col: str = "date") -> DataFrame:
    """Keep one date."""
    return df.where(F.col(col) == F.lit(parse_run_date(day)))


def in_range(df: DataFrame, start: str | dt.date, end: str | dt.date, col: str = "date") -> DataFrame:
    """Keep the closed date range ``[start, end]``; prunes ``date`` partitions."""
    return df.where(F.col(col).between(F.lit(parse_run_date(start)), F.lit(parse_run_date(end))))


def with_keys(df: DataFrame, keys: Iterable | DataFrame, col: str) -> DataFrame:
    """Keep rows whose ``col`` is one of ``keys``.

    A Python list is an ``IN`` predicate, pushed to the scan.  A DataFrame of
    keys is a left semi join, which Spark broadcasts only when AQE measures
    the key side small; long lists belong there.
    """
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).alias("__key")).distinct()
        return df.join(k, F.col(col) == k["__key"], "left_semi")
    return df.where(F.col(col).isin(list(keys)))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def all_equal(conds: dict) -> Column:
    """AND of ``col == value`` pairs."""
    out = F.lit(True)
    for c, v in conds.items():
        out = out & (F.col(c) == F.lit(v))
    return out


def any_equal(conds: dict) -> Column:
    """OR of ``col == value`` pairs."""
    out = F.lit(False)
    for c, v in conds.items():
        out = out | (F.col(c) == F.lit(v))
    return out


def with_suffix(df: DataFrame, col: str, suffix: str) -> DataFrame:
    """Case-insensitive suffix match, e.g. symbols ending in ``usdt``."""
    return df.where(F.lower(F.col(col)).endswith(suffix.lower()))
