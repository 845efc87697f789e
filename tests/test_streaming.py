"""Streaming operators: the stream gives the batch result; late data."""

from __future__ import annotations

import datetime as dt
import json
import os

from helpers import rows
from pyspark.sql import functions as F

from tallyspark.operators import changes as chg
from tallyspark.operators import features as feat
from tallyspark.streaming import streams as st

TX_SCHEMA = ("`User ID` string, `Transaction ID` string, Amount double, Vendor string, "
             "Sources string, ts timestamp")


def tx_rows():
    out = []
    for i in range(60):
        day = dt.datetime(2025, 3, 1) + dt.timedelta(days=i % 20, hours=i % 24)
        out.append((f"u{i % 4}", str(i), float(i), f"v{i % 5}", f"s{i % 3}", day))
    return out


def test_stream_window_features_equal_backfill(spark, tmp_dir):
    src = f"{tmp_dir}/tx"
    df = spark.createDataFrame(tx_rows(), TX_SCHEMA)
    df.write.parquet(src)
    stream = st.stream_files(spark, src, df.schema)
    out = st.stream_window_features(stream, "ts", watermark="0 seconds")
    q = st.start_append(out, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    # windows closed by the watermark (max event time): run dates up to the
    # day before the last event's day
    last = max(r[5] for r in tx_rows())
    end = (last - dt.timedelta(days=1)).date()
    batch = feat.backfill_features(df.withColumn("date", F.to_date("ts")),
                                   dt.date(2025, 3, 1), end)
    assert rows(got) == rows(batch)


def test_late_event_is_dropped(spark, tmp_dir):
    src = f"{tmp_dir}/tx"
    first = spark.createDataFrame([("u1", "1", 1.0, "v", "s", dt.datetime(2025, 3, 10)),
                                   ("u1", "2", 2.0, "v", "s", dt.datetime(2025, 3, 20))], TX_SCHEMA)
    late = spark.createDataFrame([("u1", "3", 100.0, "v", "s", dt.datetime(2025, 3, 1))], TX_SCHEMA)
    first.write.parquet(f"{src}/a")
    stream = st.stream_files(spark, f"{src}/*", first.schema)
    out = st.stream_window_features(stream, "ts", watermark="1 day")
    q = st.start_append(out, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    late.write.parquet(f"{src}/b")
    q = st.start_append(out, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    # the event of 03-01 is older than the watermark (03-19): it changes nothing
    assert got.where("total_amount_l1w >= 100").count() == 0
    assert got.where("date = DATE'2025-03-10'").first()["total_amount_l1w"] == 1.0


def _msg(op, id_, amount, ts_ms, lsn):
    row = {"id": id_, "User ID": "u", "Transaction ID": f"t{id_}", "Amount": amount,
           "Vendor": "v", "Sources": "s", "Time": "2025-03-10 10:00:00"}
    payload = {"before": row if op == "d" else None, "after": None if op == "d" else row,
               "op": op, "source": {"ts_ms": ts_ms, "lsn": lsn}}
    return json.dumps({"payload": payload})


def test_stream_current_state_equals_batch(spark, tmp_dir):
    batches = [
        [_msg("c", 1, 1.0, 10, 1), _msg("c", 2, 2.0, 10, 2), _msg("c", 3, 3.0, 10, 3)],
        [_msg("u", 1, 5.0, 20, 4), _msg("d", 2, None, 20, 5)],
        # late: an older update of 1 and an older create of 2 arrive last
        [_msg("u", 1, 0.5, 15, 6), _msg("c", 2, 9.0, 5, 7), _msg("c", 4, 4.0, 30, 8)],
    ]
    src = f"{tmp_dir}/msgs"
    os.makedirs(src)
    for i, b in enumerate(batches):
        with open(f"{src}/part-{i}.json", "w") as fh:
            fh.write("\n".join(b) + "\n")
    stream = st.stream_changes(spark, src, max_files_per_trigger=1)
    st.start_current_state(stream, f"{tmp_dir}/ckpt").awaitTermination()
    got = st.current_from_state(st.read_state(spark, f"{tmp_dir}/ckpt"))
    all_msgs = spark.createDataFrame([(m,) for b in batches for m in b], "value string")
    batch = chg.current_rows(chg.parse_changes(all_msgs))
    assert rows(got, "id", "Amount") == rows(batch, "id", "Amount") == [(1, 5.0), (3, 3.0), (4, 4.0)]


def test_stream_calendar_complete(spark, tmp_dir):
    src = f"{tmp_dir}/rec"
    os.makedirs(src)
    recs = [{"symbol": "BTC", "date": "2025-01-06", "price_daily": 10.0, "volume_daily": 1.0,
             "trades_daily": 1},
            {"symbol": "BTC", "date": "2025-01-07", "price_daily": 30.0, "volume_daily": 1.0,
             "trades_daily": 1}]
    for i, r in enumerate(recs):
        with open(f"{src}/r{i}.json", "w") as fh:
            fh.write(json.dumps(r) + "\n")
    from tallyspark.operators.records import parse_records
    from tallyspark.sources.tables import read_snapshot
    records = parse_records(st.stream_changes(spark, src, max_files_per_trigger=1))
    agg = st.stream_calendar_features(records, "symbol", "date", "week",
                                      {"avg_price": ("avg", "price_daily")})
    st.start_complete(agg, f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()
    assert rows(read_snapshot(spark, f"{tmp_dir}/out")) == [("BTC", 2, 20.0)]


def test_duplicate_delivery_dropped(spark, tmp_dir):
    src = f"{tmp_dir}/tx"
    df = spark.createDataFrame([("u1", "1", 1.0, "v", "s", dt.datetime(2025, 3, 10)),
                                ("u1", "1", 1.0, "v", "s", dt.datetime(2025, 3, 10)),
                                ("u1", "2", 2.0, "v", "s", dt.datetime(2025, 3, 12))], TX_SCHEMA)
    df.write.parquet(src)
    out = st.stream_window_features(st.stream_files(spark, src, df.schema), "ts",
                                    watermark="0 seconds", dedupe_key="Transaction ID")
    st.start_append(out, f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.where("date = DATE'2025-03-10'").first()["num_transactions_l1w"] == 1


def test_late_and_repeated_rows_are_counted(spark, tmp_dir):
    at = lambda day, hour=0: dt.datetime(2025, 3, day, hour)
    schema = "id long, ts timestamp, v double"
    runs = [[(1, at(10), 1.0), (1, at(10), 1.0), (2, at(12), 2.0)],
            [(2, at(12), 2.0), (3, at(11, 1), 4.0), (4, at(10, 1), 8.0), (5, at(9), 16.0), (6, at(20), 32.0)]]
    dropped = []
    for rows_of_run in runs:
        spark.createDataFrame(rows_of_run, schema).write.mode("append").parquet(f"{tmp_dir}/in")
        days = st.stream_daily_totals(st.stream_files(spark, f"{tmp_dir}/in", schema), "ts", "v", "1 day", "id")
        q = st.start_append(days, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
        q.awaitTermination()
        dropped.append(st.late_rows(q))
    # behind the watermark of 03-11: rows 4 and 5; within it: row 3; delivered again: rows 1 and 2
    assert dropped == [0, 2]
    assert rows(spark.read.parquet(f"{tmp_dir}/out")) == [
        (dt.date(2025, 3, 10), 1, 1.0), (dt.date(2025, 3, 11), 1, 4.0), (dt.date(2025, 3, 12), 1, 2.0)]


def test_windows_hold_no_sets(spark, tmp_dir):
    df = spark.createDataFrame(tx_rows(), TX_SCHEMA)
    df.write.parquet(f"{tmp_dir}/tx")
    out = st.stream_window_features(st.stream_files(spark, f"{tmp_dir}/tx", df.schema), "ts")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "collect_set" not in plan and plan.count("Aggregate") == 3
    # the first aggregate, which the events enter, has tumbling days
    assert plan.rindex("window") > plan.rindex("Aggregate")


def test_state_is_read_from_the_store(spark, tmp_dir):
    src, ckpt = f"{tmp_dir}/msgs", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    batches = [[_msg("c", 1, 1.0, 10, 1), _msg("c", 2, 2.0, 10, 2)],
               [_msg("u", 1, 5.0, 20, 3)],
               [_msg("d", 2, None, 30, 4), _msg("c", 3, 3.0, 30, 5)]]
    changed = []

    def run(first, last):
        for i in range(first, last):
            with open(f"{src}/part-{i}.json", "w") as fh:
                fh.write("\n".join(batches[i]) + "\n")
        st.start_current_state(st.stream_changes(spark, src, max_files_per_trigger=1), ckpt,
                               apply=lambda b, n: changed.append(rows(b, "id"))).awaitTermination()
        return rows(st.current_from_state(st.read_state(spark, ckpt)), "id", "Amount")

    assert run(0, 1) == [(1, 1.0), (2, 2.0)]
    assert run(1, 3) == [(1, 5.0), (3, 3.0)]
    # a batch emits only the ids it changed (files of one moment come in any order)
    assert changed[0] == [(1,), (2,)]
    assert sorted(c for c in changed[1:] if c) == [[(1,)], [(2,), (3,)]]
    assert rows(st.read_state(spark, ckpt), "id", "op") == [(1, "u"), (2, "d"), (3, "c")]


def test_complete_mode_survives_a_lost_checkpoint(spark, tmp_dir):
    from tallyspark.sources.tables import read_snapshot
    src, out = f"{tmp_dir}/rows", f"{tmp_dir}/out"
    schema = "k string, n int"
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.parquet(src)

    def run(checkpoint):
        agg = st.stream_files(spark, src, schema).groupBy("k").agg(F.sum("n").alias("n"))
        st.start_complete(agg, out, f"{tmp_dir}/{checkpoint}").awaitTermination()

    assert read_snapshot(spark, out) is None
    for i in range(4):
        spark.createDataFrame([("a", 10)], schema).write.mode("append").parquet(src)
        run("first")
    run("anew")
    assert rows(read_snapshot(spark, out)) == [("a", 41), ("b", 2)]
    assert len([d for d in os.listdir(out) if d.startswith("snapshot=")]) == 2
