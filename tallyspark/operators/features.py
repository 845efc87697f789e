"""Per-entity feature aggregates: trailing windows, backfills, calendar buckets.

Scale notes
-----------
* ``aggregate_features`` is one ``groupBy``: count/sum/min/max are combined
  map-side (partial aggregation), the two exact distinct counts go through
  Spark's ``Expand`` rewrite, which first de-duplicates (key, value) pairs,
  so a key holding a third of all rows is spread over its distinct values
  before it reaches one task.
* ``backfill_features`` never copies rows to the run dates they count for.
  Sums, counts and extremes are range frames over one partial per (key,
  date).  Exact distinct counts come from intervals: a value seen on day d
  counts for the run dates [d, d + days_back]; the intervals of a value are
  merged, each merged one leaves a +1 where it begins and a -1 behind its
  end, and a running sum over a key's dates is the number of values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import parse_run_date, window_start
from ..schemas import AMOUNT_COL, SOURCE_COL, TXN_COL, USER_COL, VENDOR_COL
from .filters import in_range


def _measures(label: str, count_col, amount, vendor, source, distinct=True):
    amt = F.col(amount)
    total = F.sum(amt)
    vend = F.count_distinct(F.col(vendor)) if distinct else F.size(F.collect_set(F.col(vendor)))
    src = F.count_distinct(F.col(source)) if distinct else F.size(F.collect_set(F.col(source)))
    return [
        F.count(F.col(count_col)).alias(f"num_transactions_{label}"),
        total.cast("double").alias(f"total_amount_{label}"),
        # mean = sum / count of non-null amounts (same as avg); computed this
        # way the result is the same for double and decimal amounts.
        (total.cast("double") / F.count(amt)).alias(f"avg_amount_{label}"),
        F.min(amt).cast("double").alias(f"min_amount_{label}"),
        F.max(amt).cast("double").alias(f"max_amount_{label}"),
        vend.cast("bigint").alias(f"num_vendors_{label}"),
        src.cast("bigint").alias(f"num_sources_{label}"),
    ]


def aggregate_features(df: DataFrame, label: str = "l1w", key: str = USER_COL,
                       count_col: str = TXN_COL, amount: str = AMOUNT_COL,
                       vendor: str = VENDOR_COL, source: str = SOURCE_COL,
                       out_key: str = "user_id", distinct: str = "exact") -> DataFrame:
    """Seven per-key aggregates over whatever rows ``df`` holds.

    ``num_transactions`` counts non-null transaction ids (not distinct);
    vendors and sources are exact distinct counts.  ``distinct="set"``
    uses ``size(collect_set)`` instead, which avoids ``Expand`` and is only
    safe for low-cardinality columns.
    """
    aggs = _measures(label, count_col, amount, vendor, source, distinct == "exact")
    return df.groupBy(F.col(key).alias(out_key)).agg(*aggs)


def window_features(df: DataFrame, run_date: str | dt.date, label: str = "l1w",
                    days_back: int = 7, date_col: str = "date", **kw) -> DataFrame:
    """Features of the closed range ``[run - days_back, run]``, labelled ``run``.

    ``days_back=7`` covers eight calendar days, both ends included, as the
    daily job does; ``days_back=6`` gives a true week.  The date filter is
    on the partition column, so only those partitions are read.
    """
    run = parse_run_date(run_date)
    rows = in_range(df, window_start(run, days_back), run, date_col)
    return aggregate_features(rows, label, **kw).withColumn("date", F.lit(run))


def with_feature_timestamp(df: DataFrame, at=None, col: str = "feature_timestamp") -> DataFrame:
    """Stamp rows with the time they were computed (``current_timestamp()``,
    one value per query), or with a given time (tests, replays)."""
    value = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn(col, value)


def _interval_events(rows: DataFrame, value: str, days_back: int, name: str) -> DataFrame:
    """(__k, __d, name): changes of the number of distinct values in the
    trailing window, from the merged intervals of each value.  A value's
    array holds its distinct days, combined before the shuffle."""
    seen = (rows.where(F.col(value).isNotNull()).groupBy("__k", value)
            .agg(F.sort_array(F.collect_set("__d")).alias("__days")))
    days, last = F.col("__days"), F.size("__days") - 1
    apart = lambda i: F.datediff(F.get(days, i), F.get(days, i - 1)) > days_back
    begins = F.filter(days, lambda d, i: (i == 0) | apart(i))
    ends = F.filter(days, lambda d, i: (i == last) | apart(i + 1))
    return seen.select("__k", F.inline(F.concat(
        F.transform(begins, lambda d: F.struct(d.alias("__d"), F.lit(1).alias(name))),
        F.transform(ends, lambda d: F.struct(F.date_add(d, days_back + 1).alias("__d"), F.lit(-1).alias(name))))))


def backfill_features(df: DataFrame, start: str | dt.date, end: str | dt.date,
                      label: str = "l1w", days_back: int = 7, date_col: str = "date",
                      key: str = USER_COL, count_col: str = TXN_COL, amount: str = AMOUNT_COL,
                      vendor: str = VENDOR_COL, source: str = SOURCE_COL,
                      out_key: str = "user_id") -> DataFrame:
    """``window_features`` for every run date in ``[start, end]`` in one job.

    Equal, run date by run date, to calling ``window_features`` once per
    day (a key gets a row for a run date when it has any row in that
    date's window).  A null key is a key of its own, null values are not
    counted.  A key's window holds its days, not its rows: every step before
    is a grouping that is combined before its shuffle.
    """
    s, e = parse_run_date(start), parse_run_date(end)
    rows = in_range(df, window_start(s, days_back), e, date_col).select(
        F.col(key).alias("__k"), F.col(date_col).alias("__d"), F.col(count_col).alias("__c"),
        F.col(amount).alias("__a"), F.col(vendor).alias("__vendor"), F.col(source).alias("__source"))
    # A key's run dates: the union of its days' intervals.
    asked = (rows.groupBy("__k").agg(F.collect_set("__d").alias("__days"))
             .select("__k", F.explode(F.array_distinct(F.flatten(F.transform("__days", lambda d: F.when(
                 F.date_add(d, days_back) >= F.lit(s), F.sequence(F.greatest(d, F.lit(s)), F.least(
                     F.date_add(d, days_back), F.lit(e)))).otherwise(F.array().cast("array<date>"))))))
                     .alias("__d"), F.lit(True).alias("__asked")))
    # All that is known of a key's day comes together in one grouping.
    line = rows.select("__k", "__d", "__c", "__a")
    for part in (asked, _interval_events(rows, "__vendor", days_back, "__dv"),
                 _interval_events(rows, "__source", days_back, "__ds")):
        line = line.unionByName(part, allowMissingColumns=True)
    line = line.groupBy("__k", "__d").agg(
        F.count("__c").alias("__n"), F.sum("__a").alias("__sum"), F.count("__a").alias("__na"),
        F.min("__a").alias("__min"), F.max("__a").alias("__max"), F.max("__asked").alias("__asked"),
        F.sum("__dv").alias("__dv"), F.sum("__ds").alias("__ds"))
    by_day = Window.partitionBy("__k").orderBy(F.datediff("__d", F.lit(s)))
    trailing = by_day.rangeBetween(-days_back, Window.currentRow)
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("__sum").over(trailing)
    values = {
        "num_transactions": F.sum("__n").over(trailing).cast("bigint"),
        "total_amount": total.cast("double"),
        "avg_amount": total.cast("double") / F.sum("__na").over(trailing),
        "min_amount": F.min("__min").over(trailing).cast("double"),
        "max_amount": F.max("__max").over(trailing).cast("double"),
        "num_vendors": F.coalesce(F.sum("__dv").over(so_far), F.lit(0)).cast("bigint"),
        "num_sources": F.coalesce(F.sum("__ds").over(so_far), F.lit(0)).cast("bigint"),
    }
    return (line.select(F.col("__k").alias(out_key), *[v.alias(f"{n}_{label}") for n, v in values.items()],
                        F.col("__d").alias("date"), "__asked")
            .where(F.col("__asked") & (F.col("date") >= F.lit(s))).drop("__asked"))


def calendar_features(df: DataFrame, key: str, date_col: str, unit: str = "week",
                      measures: dict | None = None, bucket: str = "number") -> DataFrame:
    """Per-key aggregates by calendar week or month.

    ``bucket="number"`` groups by ``weekofyear`` / ``month`` (the number
    alone, so the same week of different years is merged, as the notebook
    did); ``bucket="trunc"`` groups by the truncated date instead, which
    keeps years apart.  ``measures`` maps output name -> (function, column)
    with function one of avg, sum, min, max, count.
    """
    measures = measures or {}
    d = F.col(date_col)
    if bucket == "trunc":
        bcol = F.date_trunc(unit, d).cast("date").alias(f"{unit}_start")
    elif unit == "week":
        bcol = F.weekofyear(d).cast("bigint").alias("week_number")
    elif unit == "month":
        bcol = F.month(d).cast("bigint").alias("month")
    else:
        raise ValueError(f"unknown unit {unit!r}")
    aggs = [_calendar_measure(fn, F.col(c)).alias(name) for name, (fn, c) in measures.items()]
    return df.groupBy(F.col(key), bcol).agg(*aggs)


def _calendar_measure(fn: str, c):
    # Sums and means come out as double; the mean is sum / count of non-null
    # values (= avg), which stays exact when the input is a decimal.
    if fn == "sum":
        return F.sum(c).cast("double")
    if fn == "avg":
        return F.sum(c).cast("double") / F.count(c)
    if fn == "count":
        return F.count(c)
    if fn == "min":
        return F.min(c)
    if fn == "max":
        return F.max(c)
    raise ValueError(f"unknown measure {fn!r}")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (null order
    values count as smallest).

    Spark rows have no position, so "last" needs an order column, unique
    within a key for a fixed result.  ``row_number() = 1`` is planned with a
    partial ``WindowGroupLimit`` before the shuffle, so a hot key shrinks to
    one row per map task; a struct-valued ``max_by`` would pack every row
    twice and run as a sort aggregate on both sides.
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *[F.col(f"`{c}`").desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, start=None, end=None) -> DataFrame:
    """Newest row per key with ``start < ts <= end`` (either bound optional);
    of several at one time the one with the greatest values."""
    rows = df
    if start is not None:
        rows = rows.where(F.col(ts) > F.lit(start))
    if end is not None:
        rows = rows.where(F.col(ts) <= F.lit(end))
    return keep_last(rows, keys, [ts, *[c for c in df.columns if c not in keys and c != ts]])
