"""The daily batch jobs, end to end (each is one scheduled run per date;
``backfill_feature_days`` replaces a catch-up of many runs).

* ``daily_ingest``: change messages -> newest version per row, deletes
  removed -> the run date's rows -> date partition of the raw table.
* ``daily_features``: raw table -> trailing range (partition pruned) ->
  completeness gate -> seven aggregates -> date partition of the feature
  table.

* ``materialize_day``: feature views -> online tables, from the end before up
  to the end of the run date.

The first two overwrite only the run date's partition, so a re-run is safe,
and materializing that date again takes its corrections to the online tables;
``update_table`` replaces the partitions that a conditional update touches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.dates import parse_run_date, window_start
from .operators import changes as chg
from .operators import features as feat
from .operators import quality as dq
from .operators import rows as rw
from .operators import store
from .operators.filters import in_range
from .session import shared_path
from .sources.tables import drop_partition, read_table, write_partitions


def _write_days(day_rows: DataFrame, days: list[dt.date], out_path: str, fmt: str) -> None:
    """Overwrite the given days' partitions with ``day_rows``; days that end
    up with no rows (every row deleted or moved away) are removed, which a
    dynamic overwrite alone would leave in place.  The per-day row counts
    are observed during the write itself, so no extra job runs."""
    obs = Observation("written_days")
    counted = day_rows.observe(obs, F.collect_set("date").alias("dates"))
    write_partitions(counted, out_path, "date", fmt)
    present = set(obs.get.get("dates") or [])
    spark = day_rows.sparkSession
    for d in days:
        if d not in present:
            drop_partition(spark, out_path, "date", d, fmt)


def daily_ingest(messages: DataFrame, run_date: str | dt.date, out_path: str,
                 fmt: str = "parquet", deletes_mode: str = "any") -> DataFrame:
    """Write the run date's current rows; returns the frame that was written."""
    run = parse_run_date(run_date)
    day = chg.ingest_day(chg.parse_changes(messages), run, deletes_mode=deletes_mode)
    _write_days(day, [run], out_path, fmt)
    return day


def backfill_ingest(messages: DataFrame, start: str | dt.date, end: str | dt.date,
                    out_path: str, fmt: str = "parquet", deletes_mode: str = "any") -> DataFrame:
    """Rebuild every day of ``[start, end]`` in one job.  A row whose newest
    version moved to another day disappears from its old day as long as both
    days are in the range (single-day runs cannot remove it)."""
    s, e = parse_run_date(start), parse_run_date(end)
    rows = chg.with_event_date(chg.current_rows(chg.parse_changes(messages),
                                                deletes_mode=deletes_mode))
    days = rows.where(F.col("date").between(F.lit(s), F.lit(e))).drop("id", "ts_ms", "lsn")
    _write_days(days, [s + dt.timedelta(days=i) for i in range((e - s).days + 1)], out_path, fmt)
    return days


def daily_features(spark: SparkSession, raw_path: str, run_date: str | dt.date, out_path: str,
                   fmt: str = "parquet", days_back: int = 7, min_dates: int = 7,
                   label: str = "l1w") -> DataFrame:
    """Gate, compute and write one run date's features; returns the frame.

    Raises ``ValueError`` for a malformed date and ``IncompleteInputError``
    when fewer than ``min_dates`` dates are present in the range.
    """
    run = parse_run_date(run_date)
    raw = in_range(read_table(spark, raw_path, fmt), window_start(run, days_back), run)
    dq.require_dates(raw, min_dates)
    out = feat.window_features(raw, run, label, days_back=days_back)
    write_partitions(out, out_path, "date", fmt)
    return out


def complete_days(raw: DataFrame, start: dt.date, end: dt.date, days_back: int, min_dates: int) -> list[dt.date]:
    """The run dates of ``[start, end]`` that pass the gate, in order."""
    gate = dq.gate_dates(raw, start, end, days_back, min_dates)
    return sorted(r["date"] for r in gate.where("complete").collect())


def backfill_feature_days(spark: SparkSession, raw_path: str, start: str | dt.date, end: str | dt.date,
                          out_path: str, fmt: str = "parquet", days_back: int = 7, min_dates: int = 7,
                          incomplete: str = "error", label: str = "l1w") -> DataFrame:
    """Features of every run date of ``[start, end]`` in one job, each gated
    like a daily run.  A run date with too few dates is an error, or with
    ``incomplete="skip"`` left as it is.  Run dates that now have no rows lose
    their old partitions.  Returns the frame."""
    if incomplete not in ("error", "skip"):
        raise ValueError(f"unknown way with incomplete days {incomplete!r}")
    s, e = parse_run_date(start), parse_run_date(end)
    raw = read_table(spark, raw_path, fmt)
    days = complete_days(raw, s, e, days_back, min_dates)
    if incomplete == "error" and len(days) < (e - s).days + 1:
        raise dq.IncompleteInputError(f"only {len(days)} of {(e - s).days + 1} run dates have {min_dates} dates")
    rows = feat.backfill_features(raw, s, e, label, days_back=days_back)
    out = rows.where(F.col("date").isin(days))
    _write_days(out, days, out_path, fmt)
    return out


def materialize_day(spark: SparkSession, views: list[store.FeatureView], run_date: str | dt.date,
                    online_root: str, sources: dict[str, DataFrame] | None = None) -> dict[str, int]:
    """Materialize the views up to the end of the run date."""
    end = dt.datetime.combine(parse_run_date(run_date), dt.time.max)
    return store.materialize_all(spark, views, online_root, end, sources)


def update_table(spark: SparkSession, path: str, cond: Column, updates: dict, by: str = "date",
                 fmt: str = "parquet") -> None:
    """``UPDATE ... WHERE`` on a table partitioned by ``by``: the partitions
    that hold a matching row are rewritten, the others stay.  The new rows
    are written beside the table first, since a partition cannot be replaced
    while it is read.  The partition column itself cannot be updated."""
    if by in updates:
        raise ValueError(f"{by!r} is the partition column")
    table = read_table(spark, path, fmt)
    touched = table.where(cond).select(by).distinct()
    rows = rw.update_where(table.join(touched.withColumnRenamed(by, "__by"), F.col(by) == F.col("__by"),
                                      "left_semi"), cond, updates)
    staged = shared_path(spark, "update")
    rows.write.parquet(staged)
    write_partitions(spark.read.schema(rows.schema).parquet(staged), path, by, fmt)
