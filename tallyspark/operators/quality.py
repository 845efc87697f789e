"""Input completeness gates and feature comparison."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_run_date, window_start
from .filters import in_range


class IncompleteInputError(RuntimeError):
    """Raised when a gate finds too little input to compute features."""


def distinct_dates(df: DataFrame, col: str = "date") -> DataFrame:
    """The distinct non-null dates present (one small aggregate)."""
    return df.where(F.col(col).isNotNull()).select(col).distinct()


def count_distinct_dates(df: DataFrame, col: str = "date") -> DataFrame:
    """One row ``n_dates``: the gate's measure as a DataFrame."""
    return df.where(F.col(col).isNotNull()).agg(F.count_distinct(col).alias("n_dates"))


def require_dates(df: DataFrame, n: int = 7, col: str = "date") -> int:
    """Stop the run when fewer than ``n`` distinct dates are present.

    This is an action (one job over the partition column only); it
    returns the count so the caller can log it.
    """
    found = count_distinct_dates(df, col).first()["n_dates"]
    if found < n:
        raise IncompleteInputError(
            f"input is incomplete: {found} of at least {n} dates are present")
    return found


def gate_dates(df: DataFrame, start: str | dt.date, end: str | dt.date, days_back: int = 7, n: int = 7,
               col: str = "date") -> DataFrame:
    """The gate for every run date of ``[start, end]``: (date, n_dates,
    complete), the distinct dates present in the closed trailing range and
    whether they are ``n`` or more.  A range frame over the dates, which are
    as many as the calendar has days; the table itself is read once."""
    s, e = parse_run_date(start), parse_run_date(end)
    present = distinct_dates(in_range(df, window_start(s, days_back), e, col), col).select(
        F.col(col).cast("date").alias("date"), F.lit(1).alias("here"), F.lit(0).alias("asked"))
    runs = df.sparkSession.range((e - s).days + 1).select(
        F.date_add(F.lit(s), F.col("id").cast("int")).alias("date"), F.lit(0).alias("here"), F.lit(1).alias("asked"))
    days = present.unionByName(runs).groupBy("date").agg(F.max("here").alias("here"), F.max("asked").alias("asked"))
    trailing = Window.orderBy(F.datediff("date", F.lit(s))).rangeBetween(-days_back, Window.currentRow)
    counted = days.withColumn("n_dates", F.sum("here").over(trailing))
    return counted.where("asked = 1").select("date", "n_dates", (F.col("n_dates") >= n).alias("complete"))


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (``n_rows``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def compare_features(left: DataFrame, right: DataFrame, keys: list[str],
                     exact: list[str], approx: list[str], tol: float = 1e-3) -> DataFrame:
    """Per key: are the two feature sets equal?

    Full outer join on the keys (one shuffle per side, both on the key);
    ``exact`` columns must be equal (null-safe), ``approx`` within ``tol``.
    Output: keys, ``in_left``, ``in_right``, ``n_mismatch``, ``matches``.
    """
    l = left.select(*keys, *[F.col(c).alias(f"__l_{c}") for c in exact + approx],
                    F.lit(True).alias("__in_l"))
    r = right.select(*keys, *[F.col(c).alias(f"__r_{c}") for c in exact + approx],
                     F.lit(True).alias("__in_r"))
    j = l.join(r, keys, "full_outer")
    checks = [F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}")) for c in exact]
    for c in approx:
        a, b = F.col(f"__l_{c}"), F.col(f"__r_{c}")
        checks.append((a.isNull() & b.isNull()) | (F.abs(a - b) <= F.lit(tol)))
    bad = sum((F.when(F.coalesce(c, F.lit(False)), 0).otherwise(1) for c in checks), F.lit(0))
    in_l = F.coalesce(F.col("__in_l"), F.lit(False))
    in_r = F.coalesce(F.col("__in_r"), F.lit(False))
    return j.select(
        *keys, in_l.alias("in_left"), in_r.alias("in_right"),
        bad.cast("bigint").alias("n_mismatch"),
        (in_l & in_r & (bad == 0)).alias("matches"),
    )
