"""Driver tables as pipeline inputs.

The library operators take pipeline-shaped frames (change messages, raw
transactions, feature tables).  These builders derive them from the
shared parquet tables with Spark, so every query's work grows with the
tables.  Each builder has a twin SQL text in ``oracle.py`` that DuckDB
runs on the same parquet files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (AMOUNT_COL, SOURCE_COL, TIME_COL, TIME_FORMAT, TXN_COL,
                       USER_COL, VENDOR_COL)

# Fixed parameters of the derived inputs.
RUN_DATE = dt.date(2024, 1, 20)
BACKFILL_START = dt.date(2024, 1, 8)
BACKFILL_END = dt.date(2024, 1, 30)
CDC_EVENTS_PER_ROW = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(d: dt.date) -> Column:
    # A timestamp_ntz literal, so the comparison with the ntz column is
    # pushed to the parquet scan as is.
    return F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
           end: dt.date | None = None) -> DataFrame:
    """``events`` limited to the calendar days ``[start, end]`` at the scan."""
    ev = table(spark, sf_dir, "events")
    if start is not None:
        ev = ev.where(F.col("ts") >= _ntz(start))
    if end is not None:
        ev = ev.where(F.col("ts") < _ntz(end + dt.timedelta(days=1)))
    return ev


def source_of(props: Column) -> Column:
    return (F.get_json_object(props, "$.k").cast("int") % 3).cast("string")


def transactions(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
                 end: dt.date | None = None, exact_amount: bool = True) -> DataFrame:
    """Raw transaction rows (``User ID`` … ``Time``, ``date``) from ``events``.

    ``exact_amount`` keeps the amount as ``decimal(18,2)`` so sums are
    exact and equal DuckDB's to the last bit; features come out as double.
    """
    ev = events(spark, sf_dir, start, end)
    amount = F.col("value").cast("decimal(18,2)") if exact_amount else F.col("value")
    return ev.select(
        F.col("user_id").cast("string").alias(USER_COL),
        F.col("event_id").cast("string").alias(TXN_COL),
        amount.alias(AMOUNT_COL),
        F.col("event_type").alias(VENDOR_COL),
        source_of(F.col("props")).alias(SOURCE_COL),
        F.date_format(F.col("ts"), TIME_FORMAT).alias(TIME_COL),
        F.to_date(F.col("ts")).alias("date"),
    )


def change_ops(event_id: Column) -> Column:
    """Op of the synthetic change for an event: d / u / c by event id."""
    return (F.when(event_id % 10 == 0, F.lit("d"))
            .when(event_id % 10 < 3, F.lit("u"))
            .otherwise(F.lit("c")))


def change_rows(spark: SparkSession, sf_dir: str, exact_amount: bool = False) -> DataFrame:
    """Flat change rows: id, op, ts_ms, lsn and the transaction fields."""
    ev = table(spark, sf_dir, "events")
    amount = F.col("value").cast("decimal(18,2)").cast("double") if exact_amount else F.col("value")
    return ev.select(
        # consecutive events are successive changes of one source row
        F.expr(f"event_id div {CDC_EVENTS_PER_ROW}").cast("long").alias("id"),
        change_ops(F.col("event_id")).alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("lsn"),
        F.col("user_id").cast("string").alias(USER_COL),
        F.col("event_id").cast("string").alias(TXN_COL),
        amount.alias(AMOUNT_COL),
        F.col("event_type").alias(VENDOR_COL),
        source_of(F.col("props")).alias(SOURCE_COL),
        F.date_format(F.col("ts"), TIME_FORMAT).alias(TIME_COL),
    )


def change_messages(spark: SparkSession, sf_dir: str, row_as_text: bool = False) -> DataFrame:
    """``events`` rendered as change messages: one JSON string per row in
    ``value`` (plus ``key``), as a capture connector writes them.

    Deletes carry the row in ``before``; creates and updates in ``after``.
    Every seventh message is a bare envelope (no ``schema``/``payload``
    wrapper), the rest are wrapped, so parsing is exercised on both.
    """
    rows = change_rows(spark, sf_dir)
    row = F.struct("id", USER_COL, TXN_COL, AMOUNT_COL, VENDOR_COL, SOURCE_COL, TIME_COL)
    if row_as_text:
        row = F.to_json(row)
    is_del = F.col("op") == "d"
    payload = F.struct(
        F.when(is_del, row).alias("before"),
        F.when(~is_del, row).alias("after"),
        F.struct(F.lit("2.5.0").alias("version"), F.lit("postgresql").alias("connector"),
                 F.col("ts_ms").alias("ts_ms"), F.col("lsn").alias("lsn")).alias("source"),
        F.col("op").alias("op"),
        F.col("ts_ms").alias("ts_ms"),
    )
    wrapped = F.to_json(F.struct(
        F.struct(F.lit("struct").alias("type"), F.lit("transaction.Envelope").alias("name")
                 ).alias("schema"),
        payload.alias("payload")))
    bare = F.to_json(payload)
    return rows.select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("lsn") % 7 == 0, bare).otherwise(wrapped).alias("value"),
    )


def timed_rows(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """All transactions with a parsed ``timestamp``; with ``with_id`` also the
    numeric row ``id`` (the table-snapshot shape)."""
    tx = transactions(spark, sf_dir, exact_amount=False)
    cols = [F.col(f"`{c}`") for c in tx.columns]
    if with_id:
        cols = [F.col(f"`{TXN_COL}`").cast("long").alias("id")] + cols
    return tx.select(*cols, F.try_to_timestamp(F.col(f"`{TIME_COL}`"), F.lit(TIME_FORMAT))
                     .alias("timestamp"))


def calendar_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily price series from orders: symbol, agg_date, price (exact)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("symbol"),
                    F.to_date("o_orderdate").alias("agg_date"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def record_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat daily records from orders as rows for JSON messages."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("symbol"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                    F.col("o_totalprice").alias("price_daily"),
                    (F.col("o_totalprice") * 2).alias("volume_daily"),
                    F.col("o_custkey").cast("int").alias("trades_daily"))


def candle_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed as exchange candles: ``symbol`` + 12-element string array
    (open time ms, open, high, low, close, volume, close time ms, quote
    volume, trades, taker base, taker quote, unused)."""
    o = table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    open_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    parts = [open_ms, p, p + 10, p - 10, p + 1, F.col("o_custkey"), open_ms + 3599999, p * 2,
             F.col("o_custkey"), p / 4, p / 8, F.lit(0)]
    symbol = F.concat(F.regexp_replace(F.upper("o_orderpriority"), "[^A-Z]", ""), F.lit("USDT"))
    return o.select(symbol.alias("symbol"), F.array(*[x.cast("string") for x in parts]).alias("candle"))
