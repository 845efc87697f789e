"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
driver tables through the library operators.  Column names equal those of
the SQL twin in ``oracle.py``.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import local_date, parse_date, parse_time, window_start
from ..operators import changes as chg
from ..operators import features as feat
from ..operators import filters as flt
from ..operators import quality as dq
from ..operators import records as rec
from ..operators import rows as rw
from ..operators import store
from ..schemas import (SOURCE_COL, TIME_COL, TIME_FORMAT, TRANSACTION_ROW, USER_COL,
                       VENDOR_COL)
from ..jobs import update_table
from ..session import shared_path
from ..sources.tables import (create_schema, from_pandas, read_snapshot, read_table, register_table, to_pandas,
                              write_partitions, write_table)
from ..streaming import streams as st
from . import inputs as I
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]


def q_weekly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.window_features(I.transactions(spark, sf_dir), I.RUN_DATE, "l1w", days_back=7)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfilled daily feature table (2024-01-08 .. 2024-01-30)."""
    tx = I.transactions(spark, sf_dir)
    return feat.backfill_features(tx, I.BACKFILL_START, I.BACKFILL_END, "l1w", days_back=7)


def q_backfill_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(spark, sf_dir)


ROW_COLS = [f.name for f in TRANSACTION_ROW.fields]


def parsed_changes(spark: SparkSession, sf_dir: str, row_as_text: bool = False) -> DataFrame:
    return chg.parse_changes(I.change_messages(spark, sf_dir, row_as_text), row_as_text=row_as_text)


def _flat_changes(parsed: DataFrame) -> DataFrame:
    row = F.coalesce(F.col("after"), F.col("before"))
    return parsed.select(
        *[row[c].alias(c) for c in ROW_COLS[:1]], "op",
        F.col("source.ts_ms").alias("ts_ms"), F.col("source.lsn").alias("lsn"),
        *[row[c].alias(c) for c in ROW_COLS[1:]])


def q_cdc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_changes(parsed_changes(spark, sf_dir))


def q_cdc_parse_two_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_changes(parsed_changes(spark, sf_dir, row_as_text=True))


def q_cdc_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.upserts(parsed_changes(spark, sf_dir))


def q_cdc_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.deletes(parsed_changes(spark, sf_dir))


def q_cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.latest_changes(chg.upserts(parsed_changes(spark, sf_dir)))


def q_cdc_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.current_rows(parsed_changes(spark, sf_dir))


def q_cdc_current_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.current_rows(parsed_changes(spark, sf_dir), deletes_mode="latest")


def q_cdc_ingest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.ingest_day(parsed_changes(spark, sf_dir), I.RUN_DATE)


FEATURES_END = I.BACKFILL_END
MID = datetime.date(2024, 1, 20)


def q_feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.CUSTOMER_FEATURES.project(feature_table(spark, sf_dir))


def q_feature_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls and values out of the declared types, in a table of texts."""
    return store.check_values(V.text_features(spark, sf_dir), V.TEXT_FEATURES)


def q_latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.latest_per_key(feature_table(spark, sf_dir), ["user_id"], "date",
                               start=datetime.date(2024, 1, 15), end=datetime.date(2024, 1, 25))


def online_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.online_rows(V.CUSTOMER_FEATURES, feature_table(spark, sf_dir), end=FEATURES_END)


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as the daily jobs leave it, partitioned by date."""
    path = shared_path(spark, "features")
    write_partitions(feature_table(spark, sf_dir), path)
    return read_table(spark, path)


def q_materialize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the online table, in one run."""
    view, out = V.CUSTOMER_FEATURES, shared_path(spark, "online")
    store.materialize(spark, view, out, FEATURES_END, feature_table(spark, sf_dir))
    return store.read_online(spark, out).drop(store.RUN)


def _corrected(table: DataFrame) -> DataFrame:
    """The last day computed again: smaller values for a part of the users."""
    wrong = (F.col("date") == F.lit(FEATURES_END)) & F.col("user_id").endswith("3")
    return (table.withColumn("num_transactions_l1w", F.col("num_transactions_l1w") - F.when(wrong, 1).otherwise(0))
            .withColumn("total_amount_l1w", F.col("total_amount_l1w") - F.when(wrong, 5).otherwise(0)))


def q_materialize_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs up to the middle, up to the end (from the remembered end), a late
    one for an earlier end with rows of users seen nowhere else, and one for
    the end again after its day was corrected downward."""
    view, out = V.CUSTOMER_FEATURES, shared_path(spark, "online")
    table = _stored_features(spark, sf_dir)
    store.materialize(spark, view, out, MID, table)
    store.materialize(spark, view, out, FEATURES_END, table)
    late = table.withColumn("user_id", F.when(F.col("user_id").endswith("1"), F.concat(F.lit("late-"), "user_id"))
                            .otherwise(F.col("user_id")))
    store.materialize(spark, view, out, MID, late, start=None)
    store.materialize(spark, view, out, FEATURES_END, _corrected(table))
    return store.read_online(spark, out)


def q_online_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.get_online_features({"customer_features": online_table(spark, sf_dir)},
                                     V.online_keys(spark, sf_dir), V.REFS, [V.CUSTOMER_FEATURES])


def q_online_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a handful of keys given as plain rows."""
    keys = [r.asDict() for r in rw.first_rows(V.online_keys(spark, sf_dir), 20, ["user_id"]).collect()]
    return store.get_online_features({"customer_features": online_table(spark, sf_dir)}, keys, V.REFS,
                                     [V.CUSTOMER_FEATURES])


def q_pandas_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest orders as a pandas frame and back."""
    top = rw.top_n(I.table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 100)
    return from_pandas(spark, to_pandas(top, 100), top.schema)


def q_asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.get_historical_features(
        V.entity_rows(spark, sf_dir), V.REFS,
        {"customer_features": _stored_features(spark, sf_dir)}, [V.CUSTOMER_FEATURES])


def q_asof_features_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = [r.replace("customer_features:", "customer_features_ttl:") for r in V.REFS]
    return store.get_historical_features(
        V.entity_rows(spark, sf_dir), refs,
        {"customer_features_ttl": _stored_features(spark, sf_dir)}, [V.CUSTOMER_FEATURES_TTL])


def _registered_view(spark: SparkSession, sf_dir: str) -> store.FeatureView:
    """A view that knows only where its table lies, its format and its time column."""
    path = shared_path(spark, "registered")
    write_partitions(feature_table(spark, sf_dir), path)
    return replace(V.CUSTOMER_FEATURES, source=store.FeatureSource("feature_table", path, "parquet", "date"))


def q_registered_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows from the registered source; no frame is passed in."""
    return store.get_historical_features(V.entity_rows(spark, sf_dir), V.REFS, None, [_registered_view(spark, sf_dir)])


def q_registered_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views materialized from their registered sources; the offline one is skipped."""
    root, view = shared_path(spark, "online"), _registered_view(spark, sf_dir)
    offline = replace(view, name="customer_offline", online=False)
    runs = store.materialize_all(spark, [view, offline], root, FEATURES_END)
    parts = [store.read_online(spark, f"{root}/{name}").withColumn("view", F.lit(name)) for name in runs]
    return reduce(DataFrame.unionByName, parts)


def q_multi_view_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = V.REFS + ["customer_demographics:location", "customer_demographics:occupation"]
    return store.get_historical_features(
        V.entity_rows(spark, sf_dir), refs,
        {"customer_features": _stored_features(spark, sf_dir),
         "customer_demographics": V.demographics(spark, sf_dir)},
        [V.CUSTOMER_FEATURES, V.DEMOGRAPHICS])


def tx_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.transactions(spark, sf_dir, exact_amount=False)


def raw_table(spark: SparkSession, sf_dir: str) -> str:
    """Transactions written as the date-partitioned raw table."""
    path = shared_path(spark, "raw")
    write_partitions(tx_double(spark, sf_dir), path)
    return path


def purchase_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with a purchase on the run date (derived, grows with the data)."""
    tx = flt.on_date(tx_double(spark, sf_dir), I.RUN_DATE)
    return tx.where(F.col(VENDOR_COL) == "purchase").select(
        F.col(f"`{USER_COL}`").alias("user_id")).distinct()


def q_distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.distinct_dates(tx_double(spark, sf_dir))


def q_date_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The completeness gate's measure for the run date's window."""
    start = window_start(I.RUN_DATE, 7)
    tx = flt.in_range(tx_double(spark, sf_dir), start, I.RUN_DATE)
    return dq.count_distinct_dates(tx)


def q_gate_run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate for every run date of the backfill, with every third day missing
    in the first half of the table."""
    tx = tx_double(spark, sf_dir)
    holes = (F.dayofmonth("date") % 3 == 0) & (F.col("date") < F.lit(I.RUN_DATE))
    return dq.gate_dates(tx.where(~holes), I.BACKFILL_START, I.BACKFILL_END, days_back=7, n=7)


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.row_count(tx_double(spark, sf_dir))


def q_filter_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.on_date(tx_double(spark, sf_dir), I.RUN_DATE)


def q_filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = window_start(I.RUN_DATE, 7)
    return flt.in_range(tx_double(spark, sf_dir), start, I.RUN_DATE)


def with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without an amount, a date or both, here and there."""
    tx, n = tx_double(spark, sf_dir), F.col("`Transaction ID`").cast("long")
    return (tx.withColumn("Amount", F.when(n % 5 != 0, F.col("Amount")))
            .withColumn("date", F.when(n % 7 != 0, F.col("date"))))


def q_filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an amount and a date, of one vendor or one source."""
    rows = flt.not_null(with_holes(spark, sf_dir), "Amount", "date")
    return rows.where(flt.any_equal({VENDOR_COL: "click", SOURCE_COL: "1"}))


def q_feature_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly features stamped with the (given) time of their computation."""
    at = datetime.datetime(2024, 1, 21, 6, 0, 0)
    return feat.with_feature_timestamp(q_weekly_features(spark, sf_dir), at)


def q_date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from texts, some of them malformed: those give null."""
    o = I.table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (F.when(F.col("o_orderkey") % 4 == 0, F.regexp_replace(day, "-", "/"))
            .when(F.col("o_orderkey") % 4 == 1, F.concat(F.substring(day, 1, 5), F.lit("13-45"))).otherwise(day))
    return o.select("o_orderkey", text.alias("text"), parse_date(text).alias("day"),
                    parse_date(text).isNotNull().alias("valid"))


def q_filter_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.with_keys(tx_double(spark, sf_dir), purchase_keys(spark, sf_dir), USER_COL)


def q_inner_join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ft = flt.on_date(feature_table(spark, sf_dir), I.RUN_DATE)
    return ft.join(purchase_keys(spark, sf_dir), on="user_id", how="inner")


def q_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rw.first_rows(V.demographics(spark, sf_dir), 10, ["user_id"])


def q_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rw.top_n(I.table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 5)


def q_compare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"{n}_l1w" for n in ("num_transactions", "total_amount", "min_amount",
                                  "max_amount", "num_vendors", "num_sources")]
    # Made to differ: some users are missing on either side, some totals are off.
    stored = (flt.on_date(feature_table(spark, sf_dir), I.RUN_DATE)
              .where(~F.col("user_id").endswith("7"))
              .withColumn("total_amount_l1w", F.col("total_amount_l1w")
                          + F.when(F.col("user_id").endswith("5"), 1).otherwise(0))
              .withColumn("avg_amount_l1w", F.col("avg_amount_l1w")
                          + F.when(F.col("user_id").endswith("4"), 0.5).otherwise(0.0)))
    fresh = q_weekly_features(spark, sf_dir).where(~F.col("user_id").endswith("3"))
    return dq.compare_features(fresh, stored, ["user_id"],
                               exact=names, approx=["avg_amount_l1w"], tol=1e-3)


def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.union_feeds(I.timed_rows(spark, sf_dir), I.timed_rows(spark, sf_dir, with_id=True))


def q_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.combine(I.timed_rows(spark, sf_dir), I.timed_rows(spark, sf_dir, with_id=True),
                       key="Transaction ID", order=("timestamp", "id"))


def q_partition_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after the run date was written again with fewer rows."""
    path = raw_table(spark, sf_dir)
    again = flt.on_date(tx_double(spark, sf_dir), I.RUN_DATE).where(F.col(VENDOR_COL) == "purchase")
    write_partitions(again, path)
    return read_table(spark, path)


def q_update_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after a conditional update of some dates."""
    path = raw_table(spark, sf_dir)
    cond = (F.col(VENDOR_COL) == "click") & (F.col("date") >= F.lit(I.RUN_DATE))
    update_table(spark, path, cond, {SOURCE_COL: "0"})
    return read_table(spark, path)


def _catalog_table(spark: SparkSession, sf_dir: str) -> str:
    """The raw table registered in the session catalog, twice (the second time is harmless)."""
    path = raw_table(spark, sf_dir)
    name = f"tallyspark_{path[-12:]}"
    create_schema(spark, name, shared_path(spark, name))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tx_double(spark, sf_dir).schema)
    for _ in range(2):
        register_table(spark, f"{name}.raw_transactions", path, schema=cols, partitioned_by=["date"])
    return name


def q_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range of a registered table, read by name; the registration goes
    afterwards, the files stay."""
    name, out = _catalog_table(spark, sf_dir), shared_path(spark, "from-catalog")
    rows = flt.in_range(spark.table(f"{name}.raw_transactions"), window_start(I.RUN_DATE, 7), I.RUN_DATE)
    write_table(rows, out)
    spark.sql(f"DROP SCHEMA {name} CASCADE")
    return read_table(spark, out)


def q_partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing range of the partitioned raw table: only its folders are read."""
    raw = read_table(spark, raw_table(spark, sf_dir))
    return flt.in_range(raw, window_start(I.RUN_DATE, 7), I.RUN_DATE)


def _round_trip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    parts = I.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    path = shared_path(spark, f"parts-{fmt}")
    write_table(parts, path, fmt)
    return read_table(spark, path, fmt, schema=parts.schema)


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "csv")


def q_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


def q_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "names")
    write_table(I.table(spark, sf_dir, "part").select("p_name"), path, "text")
    return read_table(spark, path, "text").groupBy("value").agg(F.count("*").alias("n"))


def q_update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    cond = (F.col(VENDOR_COL) == "click") & (F.col(SOURCE_COL) == "1")
    return rw.update_where(tx_double(spark, sf_dir), cond, {SOURCE_COL: "0"})


def q_rows_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo = V.demographics(spark, sf_dir)
    msgs = rec.to_messages(demo, key="user_id")
    back = F.from_json("value", demo.schema)
    return msgs.select("key", back.alias("r")).select("key", "r.*")


def q_scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = I.table(spark, sf_dir, "events")
    text = F.date_format("ts", TIME_FORMAT)
    parsed = parse_time(text)
    day = F.to_date(parsed)
    ms = F.unix_millis(parsed)
    return ev.select(
        "event_id",
        day.alias("day"),
        parse_date(F.date_format("ts", "yyyy-MM-dd")).alias("day2"),
        F.date_sub(day, 7).alias("week_ago"),
        F.weekofyear(day).alias("week_number"),
        F.month(day).alias("month"),
        F.hour(parsed).alias("hour"),
        ms.alias("epoch_ms"),
        F.date_format(F.timestamp_millis(ms), TIME_FORMAT).alias("back_text"),
        F.date_format(day, "yyyyMMdd").alias("day_compact"),
        F.regexp_replace(day.cast("string"), "-", "").alias("day_compact2"),
        local_date("ts", "Asia/Ho_Chi_Minh").alias("local_day"),
    )


def q_scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    m = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    size_text = F.col("p_size").cast("string")
    return p.select(
        "p_partkey",
        F.lower("p_name").alias("name_lower"),
        F.lower("p_name").endswith("bolt").alias("is_bolt"),
        F.col("p_name").contains("red").alias("has_red"),
        F.get(words, 0).alias("first_word"),
        F.get(words, 1).alias("second_word"),
        F.regexp_replace("p_brand", "#", "-").alias("brand_code"),
        size_text.alias("size_text"),
        # text minus a number; the type is fixed so the result does not
        # depend on the session's ANSI setting
        (size_text - 1).cast("bigint").alias("size_minus_one"),
        F.col("p_retailprice").cast("float").alias("price_f32"),
        F.element_at(m, F.lit("type")).alias("type_from_map"),
        F.map_contains_key(m, "size").alias("has_size"),
    )


def q_filter_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.with_suffix(I.table(spark, sf_dir, "part"), "p_name", "BOLT")


CAL_MEASURES = {"avg_price": ("avg", "price"), "total_volume": ("sum", "price"),
                "total_trades": ("count", "price")}


def q_weekofyear_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.calendar_features(I.calendar_input(spark, sf_dir), "symbol", "agg_date",
                                  "week", CAL_MEASURES)


def q_week_trunc_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.calendar_features(I.calendar_input(spark, sf_dir), "symbol", "agg_date",
                                  "week", CAL_MEASURES, bucket="trunc")


def q_month_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.calendar_features(I.calendar_input(spark, sf_dir), "symbol", "agg_date",
                                  "month", CAL_MEASURES)


def q_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.keep_last(I.table(spark, sf_dir, "orders"), ["o_custkey"],
                          ["o_orderdate", "o_orderkey"])


def q_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.parse_records(rec.to_messages(I.record_messages(spark, sf_dir)))


def q_candle_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.shape_candles(I.candle_arrays(spark, sf_dir))


def q_stream_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions land as files; the stream computes trailing features per
    closed window (watermark 1 day) into an append-only table."""
    src, sink = shared_path(spark, "tx-files"), shared_path(spark, "stream-features")
    tx = I.transactions(spark, sf_dir).withColumn("ts", parse_time(F.col(f"`{TIME_COL}`")))
    tx.write.parquet(src)
    stream = st.stream_files(spark, src, tx.schema)
    q = st.start_append(st.stream_window_features(stream, "ts", watermark="1 day"),
                        sink, shared_path(spark, "ckpt"))
    q.awaitTermination()
    return spark.read.parquet(sink)


def q_stream_late_and_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed in two runs.  The first holds the rows up to a cut, some twice;
    the second the rest, repeats of rows within the watermark, new rows
    within it, and new rows behind it, which are dropped and counted."""
    ev = I.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"))
    cut, n = F.lit(datetime.datetime(2024, 1, 21)).cast("timestamp"), F.col("event_id")
    last_day = (F.col("ts") < cut) & (F.col("ts") >= cut - F.expr("INTERVAL 1 DAY"))
    first = ev.where(F.col("ts") < cut)
    first = first.union(first.where(n % 5 == 0))
    near = ev.where(last_day & (n % 13 == 0)).withColumn("event_id", n + 2_000_000_000)
    late = (ev.where((F.col("ts") < cut - F.expr("INTERVAL 6 DAYS")) & (n % 11 == 0))
            .withColumn("event_id", n + 1_000_000_000))
    second = ev.where(F.col("ts") >= cut).union(ev.where(last_day & (n % 7 == 0))).union(near).union(late)
    src, sink, checkpoint = (shared_path(spark, x) for x in ("feed", "days", "ckpt"))
    dropped = 0
    for rows in (first, second):
        rows.write.mode("append").parquet(src)
        days = st.stream_daily_totals(st.stream_files(spark, src, ev.schema), "ts", "value", "2 days", "event_id")
        q = st.start_append(days, sink, checkpoint)
        q.awaitTermination()
        dropped += st.late_rows(q)
    return spark.read.parquet(sink).withColumn("n_dropped", F.lit(dropped).cast("long"))


def q_stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages land as files in two runs; the state store keeps the
    newest version per id with sticky deletes and is read back."""
    src, checkpoint = shared_path(spark, "change-files"), shared_path(spark, "ckpt")
    messages = I.change_messages(spark, sf_dir).select("value")
    for half in (0, 1):
        messages.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half).write.mode("append").text(src)
        st.start_current_state(st.stream_changes(spark, src), checkpoint).awaitTermination()
    return st.current_from_state(st.read_state(spark, checkpoint))


def _stream_calendar(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """JSON records land as files; per-symbol aggregates in complete mode,
    each trigger writing a new snapshot of the result table."""
    src, out = shared_path(spark, "record-files"), shared_path(spark, unit)
    rec.to_messages(I.record_messages(spark, sf_dir)).select("value").write.text(src)
    records = rec.parse_records(st.stream_changes(spark, src))
    cal = records.select("symbol", F.col("date").alias("agg_date"),
                         F.col("price_daily").cast("decimal(18,2)").alias("price"))
    agg = st.stream_calendar_features(cal, "symbol", "agg_date", unit, CAL_MEASURES)
    st.start_complete(agg, out, shared_path(spark, "ckpt")).awaitTermination()
    return read_snapshot(spark, out)


def q_stream_calendar_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_calendar(spark, sf_dir, "week")


def q_stream_calendar_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_calendar(spark, sf_dir, "month")


QUERIES: dict[str, Query] = {
    "weekly_features": q_weekly_features,
    "backfill_features": q_backfill_features,
    "date_gate": q_date_gate,
    "distinct_dates": q_distinct_dates,
    "gate_run_dates": q_gate_run_dates,
    "row_count": q_row_count,
    "filter_date": q_filter_date,
    "filter_range": q_filter_range,
    "filter_keys": q_filter_keys,
    "filter_not_null": q_filter_not_null,
    "feature_timestamp": q_feature_timestamp,
    "date_texts": q_date_texts,
    "filter_suffix": q_filter_suffix,
    "inner_join_keys": q_inner_join_keys,
    "first_rows": q_first_rows,
    "top_n": q_top_n,
    "compare_features": q_compare_features,
    "cdc_parse": q_cdc_parse,
    "cdc_parse_two_step": q_cdc_parse_two_step,
    "cdc_upserts": q_cdc_upserts,
    "cdc_deletes": q_cdc_deletes,
    "cdc_latest": q_cdc_latest,
    "cdc_anti_join": q_cdc_anti_join,
    "cdc_current_latest": q_cdc_current_latest,
    "cdc_ingest_day": q_cdc_ingest_day,
    "union_by_name": q_union_by_name,
    "union_dedup": q_union_dedup,
    "update_where": q_update_where,
    "partition_rerun": q_partition_rerun,
    "partition_range": q_partition_range,
    "catalog_table": q_catalog_table,
    "update_table": q_update_table,
    "csv_round_trip": q_csv_round_trip,
    "json_round_trip": q_json_round_trip,
    "text_round_trip": q_text_round_trip,
    "rows_to_json": q_rows_to_json,
    "json_records": q_json_records,
    "candle_shape": q_candle_shape,
    "scalar_dates": q_scalar_dates,
    "scalar_strings": q_scalar_strings,
    "weekofyear_agg": q_weekofyear_agg,
    "week_trunc_agg": q_week_trunc_agg,
    "month_agg": q_month_agg,
    "keep_last": q_keep_last,
    "feature_projection": q_feature_projection,
    "feature_schema_check": q_feature_schema_check,
    "latest_features": q_latest_features,
    "materialize_full": q_materialize_full,
    "materialize_incremental": q_materialize_incremental,
    "online_lookup": q_online_lookup,
    "online_lookup_rows": q_online_lookup_rows,
    "pandas_round_trip": q_pandas_round_trip,
    "asof_features": q_asof_features,
    "asof_features_ttl": q_asof_features_ttl,
    "multi_view_features": q_multi_view_features,
    "registered_history": q_registered_history,
    "registered_online": q_registered_online,
    "stream_window_features": q_stream_window_features,
    "stream_late_and_duplicates": q_stream_late_and_duplicates,
    "stream_current_state": q_stream_current_state,
    "stream_calendar_weekly": q_stream_calendar_weekly,
    "stream_calendar_monthly": q_stream_calendar_monthly,
}
