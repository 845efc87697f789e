"""File sources and sinks, connector options, records, rows operators."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyspark.functions import dates
from tallyspark.operators import filters as flt
from tallyspark.operators import records as rec
from tallyspark.operators import rows as rw
from tallyspark.sources import connectors as cn
from tallyspark.sources import tables as tb


def test_read_write_formats(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1, 2.5), ("b", 2, 3.5)], "name string, n int, x double")
    for fmt in ("parquet", "csv", "json", "orc"):
        tb.write_table(df, f"{tmp_dir}/{fmt}", fmt)
        back = tb.read_table(spark, f"{tmp_dir}/{fmt}", fmt, schema=df.schema)
        assert rows(back) == rows(df), fmt
    tb.write_table(df.select("name"), f"{tmp_dir}/text", "text")
    assert rows(tb.read_table(spark, f"{tmp_dir}/text", "text")) == [("a",), ("b",)]
    # delta without its data source is an error, never plain files
    tb.write_table(df, f"{tmp_dir}/files", "parquet")
    for act in (lambda: tb.write_table(df, f"{tmp_dir}/delta", "delta"),
                lambda: tb.write_partitions(df, f"{tmp_dir}/delta", "name", "delta"),
                lambda: tb.read_table(spark, f"{tmp_dir}/files", "delta"),
                lambda: tb.drop_partition(spark, f"{tmp_dir}/files", "n", 1, "delta")):
        with pytest.raises(tb.MissingFormat):
            act()
    with pytest.raises(ValueError):
        tb.read_table(spark, tmp_dir, "xml")


def test_dynamic_partition_overwrite(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    a = spark.createDataFrame([("x", d1), ("y", d2)], "v string, date date")
    tb.write_partitions(a, path)
    b = spark.createDataFrame([("z", d2)], "v string, date date")
    tb.write_partitions(b, path)
    assert rows(spark.read.parquet(path)) == [("x", d1), ("z", d2)]
    tb.drop_partition(spark, path, "date", d2)
    assert rows(spark.read.parquet(path)) == [("x", d1)]


def test_register_table(spark, tmp_dir):
    path = f"{tmp_dir}/feat"
    df = spark.createDataFrame([("u", 1, dt.date(2025, 3, 1))], "user_id string, n bigint, date date")
    tb.write_partitions(df, path)
    tb.create_schema(spark, "tallyspark_test")
    tb.register_table(spark, "tallyspark_test.features", path, "parquet",
                      schema="user_id string, n bigint, date date", partitioned_by=["date"])
    tb.register_table(spark, "tallyspark_test.features", path, "parquet",
                      schema="user_id string, n bigint, date date", partitioned_by=["date"])
    assert spark.table("tallyspark_test.features").count() == 1
    assert spark.sql("SELECT * FROM tallyspark_test.features LIMIT 10").count() == 1


def test_kafka_and_jdbc_options():
    cfg = cn.TopicConfig("broker:9092", "cdc.public.transaction_data")
    r = cn.kafka_read_options(cfg)
    assert r["subscribe"] == "cdc.public.transaction_data" and r["startingOffsets"] == "earliest"
    r2 = cn.kafka_read_options(cn.TopicConfig("b", "t", starting_timestamp=1700000000000))
    assert "startingOffsets" not in r2 and r2["startingTimestamp"] == "1700000000000"
    w = cn.kafka_write_options(cfg)
    assert (w["kafka.acks"], w["kafka.retries"], w["kafka.compression.type"]) == ("all", "3", "gzip")
    j = cn.JdbcConfig("jdbc:postgresql://db:5432/app", "transaction_data", "u", "p")
    o = cn.jdbc_read_options(j, "id", 1, 1000, 8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8"
    with pytest.raises(ValueError):
        cn.jdbc_read_options(j, "id")
    assert cn.jdbc_write_options(j, "age INT")["createTableColumnTypes"] == "age INT"


def test_messages_round_trip(spark):
    df = spark.createDataFrame([("u1", 1.5, None)], "user_id string, x double, y string")
    m = rec.to_messages(df, key="user_id").first()
    assert m["key"] == "u1" and json.loads(m["value"]) == {"user_id": "u1", "x": 1.5}


def test_parse_records(spark):
    msgs = spark.createDataFrame([
        (json.dumps({"symbol": "BTC", "date": "2025-03-04", "price_daily": 1.0,
                     "volume_daily": 2.0, "trades_daily": 3}),),
        (json.dumps({"symbol": "ETH", "date": "bad"}),), ("nope",)], "value string")
    out = rec.parse_records(msgs)
    assert rows(out, "symbol", "date") == [("BTC", dt.date(2025, 3, 4)), ("ETH", None)]


def test_shape_candles(spark):
    c = ["1740960000000", "1", "3", "0.5", "2", "10", "1740963599999", "20", "7", "1", "1", "0"]
    df = spark.createDataFrame([("BTCUSDT", c)], "symbol string, candle array<string>")
    r = rec.shape_candles(df).first()
    assert (r["symbols"], r["lastPrice"], r["highPrice"], r["lowPrice"], r["quoteVolume"],
            r["count"], r["date"], r["hour"]) == ("BTCUSDT", 2.0, 3.0, 0.5, 20.0, 7, "2025-03-03", 0)


def test_rows_operators(spark):
    df = spark.createDataFrame([(i, "Sending Out" if i % 2 else "Shop",
                                 "Credit Card") for i in range(10)],
                               "n int, Vendor string, Sources string")
    assert [r["n"] for r in rw.first_rows(df, 3, ["n"]).collect()] == [0, 1, 2]
    assert [r["n"] for r in rw.top_n(df, ["n"], 2).collect()] == [9, 8]
    up = rw.update_where(df, (F.col("Vendor") == "Sending Out") & (F.col("Sources") == "Credit Card"),
                         {"Sources": "Current Account"})
    assert up.where("Sources = 'Current Account'").count() == 5 and up.columns == df.columns


def test_filters(spark):
    df = spark.createDataFrame([("BTCUSDT", 1, dt.date(2025, 3, 1)), ("ETHBTC", 2, dt.date(2025, 3, 9)),
                                ("xrpusdt", None, dt.date(2025, 3, 5))], "s string, n int, date date")
    assert rows(flt.with_suffix(df, "s", "USDT"), "s") == [("BTCUSDT",), ("xrpusdt",)]
    assert rows(flt.in_range(df, "2025-03-01", "2025-03-05"), "s") == [("BTCUSDT",), ("xrpusdt",)]
    assert rows(flt.on_date(df, "2025-03-09"), "s") == [("ETHBTC",)]
    assert rows(flt.with_keys(df, ["ETHBTC"], "s"), "s") == [("ETHBTC",)]
    keys = spark.createDataFrame([("BTCUSDT",)], "k string")
    assert rows(flt.with_keys(df, keys, "s"), "s") == [("BTCUSDT",)]
    many = [f"k{i}" for i in range(2000)] + ["xrpusdt"]
    assert rows(flt.with_keys(df, many, "s"), "s") == [("xrpusdt",)]
    assert rows(flt.not_null(df, "n"), "s") == [("BTCUSDT",), ("ETHBTC",)]
    assert rows(df.where(flt.any_equal({"n": 1, "s": "ETHBTC"})), "s") == [("BTCUSDT",), ("ETHBTC",)]
    assert rows(df.where(flt.all_equal({"n": 1, "s": "BTCUSDT"})), "s") == [("BTCUSDT",)]


def test_dates():
    assert dates.parse_run_date("2025-03-18") == dt.date(2025, 3, 18)
    assert dates.window_start("2025-03-18") == dt.date(2025, 3, 11)
    for bad in ("2025-3-18", "18/03/2025", "2025-02-30", None, ""):
        with pytest.raises(ValueError):
            dates.parse_run_date(bad)


def test_date_columns(spark):
    df = spark.createDataFrame([("2025-03-04 23:30:00", 1741131000000)], "t string, ms long")
    r = df.select(dates.parse_time("t").alias("ts"), dates.parse_date(F.lit("bad")).alias("bad"),
                  dates.local_date(dates.parse_time("t"), "Asia/Ho_Chi_Minh").alias("local"),
                  dates.compact_date(F.lit(dt.date(2025, 3, 4))).alias("c"),
                  dates.epoch_millis(dates.from_epoch_millis("ms")).alias("ms2")).first()
    assert r["bad"] is None and r["local"] == dt.date(2025, 3, 5) and r["c"] == "20250304"
    assert r["ms2"] == 1741131000000


def test_table_log(spark):
    log = spark.createDataFrame(
        [(i, f"2025-01-0{i}", op, params) for i, op, params in (
            (1, "CREATE TABLE", {}), (2, "STREAMING UPDATE", {"checkpointLocation": "/ck"}), (3, "OPTIMIZE", {}),
            (4, "DELETE", {}), (5, "VACUUM END", {}), (6, "DELETE", {}))],
        "version long, timestamp string, operation string, operationParameters map<string,string>")
    assert [r.version for r in tb.newest_operations(log).collect()] == [6, 5, 4, 3, 2]
    assert rows(tb.last_checkpoint(log)) == [(2, "STREAMING UPDATE", "/ck")]
    plain = log.unionByName(spark.createDataFrame([(7, "2025-01-07", "WRITE", {})], log.schema))
    assert rows(tb.last_checkpoint(plain)) == [(7, "WRITE", None)]
    assert rows(tb.last_checkpoint(log.where("version = 1"))) == []


def test_registered_table_is_pruned_by_name(spark, tmp_dir):
    df = spark.createDataFrame([(i, dt.date(2025, 3, 1 + i % 5)) for i in range(20)], "n int, date date")
    tb.write_partitions(df, f"{tmp_dir}/raw")
    name = f"reg_{os.path.basename(tmp_dir).replace('-', '_')}"
    tb.create_schema(spark, name, f"{tmp_dir}/db")
    for _ in range(2):
        tb.register_table(spark, f"{name}.raw", f"{tmp_dir}/raw", schema="n int, date date", partitioned_by=["date"])
    part = spark.table(f"{name}.raw").where("date = DATE'2025-03-02'")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: []" in plan
    assert sorted(r.n for r in part.collect()) == [1, 6, 11, 16]
    spark.sql(f"DROP SCHEMA {name} CASCADE")
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 20  # the files stay


def test_snapshots(spark, tmp_dir):
    assert tb.read_snapshot(spark, f"{tmp_dir}/t") is None
    empty = spark.createDataFrame([], "n int")
    tb.write_snapshot(empty, f"{tmp_dir}/t")
    assert tb.read_snapshot(spark, f"{tmp_dir}/t") is None
    for n in range(4):  # each is built from the one before
        before = tb.read_snapshot(spark, f"{tmp_dir}/t")
        rows = spark.createDataFrame([(n,)], "n int")
        tb.write_snapshot(rows if before is None else before.union(rows), f"{tmp_dir}/t")
    assert sorted(r.n for r in tb.read_snapshot(spark, f"{tmp_dir}/t").collect()) == [0, 1, 2, 3]
    assert len([x for x in os.listdir(f"{tmp_dir}/t") if x.startswith("snapshot=")]) == 2
