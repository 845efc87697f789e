"""Structured Streaming forms of the pipeline.

* ``stream_changes``: change messages as a stream (Kafka, or a folder of
  newline-delimited JSON messages where no broker is present).
* ``stream_window_features``: trailing ``days_back + 1``-day features per
  entity from a transaction stream - a sliding event-time window (one-day
  slide) with a watermark, by chained aggregates over daily partials (exact
  ``count_distinct`` is refused on streams, and no sets are kept).  Append
  mode: a window is emitted once, when the watermark passes its end, and its
  state is dropped.
* ``stream_calendar_features``: week / month buckets in complete mode; every
  trigger writes the whole result as the next snapshot of a table.
* ``start_current_state``: newest version of every row id, kept in Spark's
  state store, which ``read_state`` reads back through the state data source.
  Deleted ids stay as markers so a late, older change cannot bring a row back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import changes as chg
from ..operators.features import calendar_features
from ..schemas import (AMOUNT_COL, SOURCE_COL, TRANSACTION_ROW, TXN_COL, USER_COL,
                       VENDOR_COL)
from ..sources.connectors import TopicConfig, kafka_read_options
from ..sources.tables import write_snapshot


def stream_changes(spark: SparkSession, path: str | None = None, cfg: TopicConfig | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream with one ``value`` column of change messages."""
    if cfg is not None:
        return (spark.readStream.format("kafka").options(**kafka_read_options(cfg, True))
                .load().select(F.col("value").cast("string").alias("value")))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of files as a stream (schema given: no inference)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_window_features(tx: DataFrame, ts_col: str, label: str = "l1w", days_back: int = 7,
                           watermark: str = "1 day", dedupe_key: str | None = None,
                           key: str = USER_COL, count_col: str = TXN_COL,
                           amount: str = AMOUNT_COL, vendor: str = VENDOR_COL,
                           source: str = SOURCE_COL, out_key: str = "user_id") -> DataFrame:
    """Trailing features per key and run date from a transaction stream.

    Window ``[run - days_back, run + 1 day)`` at a one-day slide, so the
    run date is the window end minus one day - the same rows as the batch
    ``window_features`` of that date.  ``dedupe_key`` drops duplicate
    deliveries within the watermark.

    Three chained aggregates in append mode, without sets.  An event enters
    the state once, in the partial row of its (key, day, vendor, source).
    When the watermark closes the day, its partials go to the windows that
    hold it, one state row per (window, key, vendor) and per (window, key,
    source); when a window closes, these are counted.
    """
    rows = tx.withWatermark(ts_col, watermark)
    if dedupe_key:
        rows = rows.dropDuplicatesWithinWatermark([dedupe_key])
    amt = F.col(f"`{amount}`")
    daily = rows.groupBy(F.window(F.col(ts_col), "1 day").alias("d"), F.col(f"`{key}`").alias(out_key),
                         F.col(f"`{vendor}`").cast("string").alias("v"), F.col(f"`{source}`").cast("string").alias("s")
                         ).agg(F.count(F.col(f"`{count_col}`")).alias("n"), F.sum(amt).alias("total"),
                               F.count(amt).alias("na"), F.min(amt).alias("least"), F.max(amt).alias("most"))
    # A partial counts once with its vendor, and once more for its source alone.
    measures = ("n", "total", "na", "least", "most")
    kinds = F.array(F.struct(F.lit("v").alias("kind"), F.col("v").alias("value"), *[F.col(c) for c in measures]),
                    F.struct(F.lit("s").alias("kind"), F.col("s").alias("value"),
                             *[F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in measures]))
    each = (daily.select(F.window_time("d").alias("t"), out_key, F.inline(kinds))
            .groupBy(F.window("t", f"{days_back + 1} days", "1 day").alias("w"), out_key, "kind", "value")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("na").alias("na"),
                 F.min("least").alias("least"), F.max("most").alias("most")))
    total = F.sum("total")
    known = F.col("value").isNotNull()
    agg = each.groupBy("w", out_key).agg(
        F.sum("n").alias(f"num_transactions_{label}"),
        total.cast("double").alias(f"total_amount_{label}"),
        (total.cast("double") / F.sum("na")).alias(f"avg_amount_{label}"),
        F.min("least").cast("double").alias(f"min_amount_{label}"),
        F.max("most").cast("double").alias(f"max_amount_{label}"),
        F.count_if((F.col("kind") == "v") & known).alias(f"num_vendors_{label}"),
        F.count_if((F.col("kind") == "s") & known).alias(f"num_sources_{label}"),
    )
    names = [f"{n}_{label}" for n in ("num_transactions", "total_amount", "avg_amount",
                                       "min_amount", "max_amount", "num_vendors", "num_sources")]
    return agg.select(out_key, *names,
                      F.date_sub(F.to_date(F.col("w.end")), 1).alias("date"))


def stream_daily_totals(rows: DataFrame, ts_col: str, amount: str, watermark: str,
                        dedupe_key: str | None = None) -> DataFrame:
    """(day, n_rows, total) of each day once the watermark has passed it.
    ``dedupe_key`` drops repeated deliveries within the watermark; rows behind
    the watermark are dropped, and ``late_rows`` counts them."""
    rows = rows.withWatermark(ts_col, watermark)
    if dedupe_key:
        rows = rows.dropDuplicatesWithinWatermark([dedupe_key])
    days = rows.groupBy(F.window(ts_col, "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(amount).cast("double").alias("total"))
    return days.select(F.to_date("w.start").alias("day"), "n_rows", "total")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query dropped for being behind
    the watermark, by its progress reports (a deduplication counts rows, an
    aggregate the groups of a task)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def stream_calendar_features(records: DataFrame, key: str, date_col: str, unit: str = "week",
                             measures: dict | None = None, bucket: str = "number") -> DataFrame:
    """``calendar_features`` on a stream (run it in complete mode)."""
    return calendar_features(records, key, date_col, unit, measures, bucket)


def start_append(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                 available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Append each finished row to a file table (exactly once through the
    file sink's own log)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(path)


def start_complete(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Complete-mode aggregate: each trigger writes the whole result as the
    next snapshot of the table at ``path``.  A replayed batch, or a stream
    begun anew from a lost checkpoint, writes a newer snapshot again."""
    w = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, _: write_snapshot(batch, path)))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _state_rows(parsed: DataFrame, ops, key: str) -> DataFrame:
    """Parsed changes as state rows: upserts, plus delete markers."""
    up = chg.upserts(parsed, ops, key)
    dl = chg.deletes(parsed, key, with_order=True).withColumn("op", F.lit("d"))
    return up.unionByName(dl, allowMissingColumns=True).where(F.col(key).isNotNull())


def _newest_agg(rows: DataFrame, key: str, order, deletes_mode: str) -> DataFrame:
    """Newest entry per id: one ``max_by`` per id, kept in the state store
    (window ranking is refused on streams).  ``"any"``: a delete marker wins
    over every upsert of its id (deleted once, gone); ``"latest"``: plain order."""
    rest = [c for c in rows.columns if c != key]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    rank = [F.col(c) for c in order]
    if deletes_mode == "any":
        rank = [(F.col("op") == "d").cast("int")] + rank
    agg = rows.groupBy(key).agg(F.max_by(packed, F.struct(*rank)).alias("__r"))
    return agg.select(key, *[F.col("__r")[c].alias(c) for c in rest])


def current_from_state(state: DataFrame) -> DataFrame:
    """Live rows of a state table (delete markers removed)."""
    return state.where(F.col("op") != "d")


def start_current_state(messages: DataFrame, checkpoint: str, row_schema: T.StructType = TRANSACTION_ROW,
                        ops=chg.UPSERT_OPS, key: str = "id", order=("ts_ms", "lsn"),
                        deletes_mode: str = "any", available_now: bool = True, apply=None) -> StreamingQuery:
    """Keep the current version of every row id from a change stream.

    The newest version per id lives in Spark's state store (a streaming
    ``max_by`` aggregation in update mode, fault tolerant through the
    checkpoint; use the RocksDB provider for large states), and
    ``read_state`` reads it from there.  A micro-batch emits only the ids it
    changed; ``apply(batch, batch_id)`` gets them where an outside table is
    to follow (a MERGE, say).
    """
    rows = _state_rows(chg.parse_changes(messages, row_schema), ops, key)
    w = (_newest_agg(rows, key, order, deletes_mode).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint))
    w = w.foreachBatch(apply) if apply else w.format("noop")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest entry per id (delete markers included) as of the last
    committed batch of ``start_current_state``: its aggregate's state, read
    store partition by store partition."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.valueWithExtremumOrdering.*")
