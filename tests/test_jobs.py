"""The daily jobs end to end on files."""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import types

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyspark import jobs
from tallyspark.__main__ import main
from tallyspark.operators import features as feat
from tallyspark.operators import quality as dq
from tallyspark.operators.quality import IncompleteInputError
from tallyspark.sources import tables as tb


def _msg(i, day, op="c"):
    row = {"id": i, "User ID": f"u{i % 2}", "Transaction ID": str(i), "Amount": float(i),
           "Vendor": f"v{i % 3}", "Sources": "Debit Card", "Time": f"{day} 10:00:00"}
    payload = {"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op,
               "source": {"ts_ms": i, "lsn": i}}
    return json.dumps({"payload": payload})


def test_ingest_then_features(spark, tmp_dir):
    days = [dt.date(2025, 3, 10) + dt.timedelta(days=k) for k in range(8)]
    msgs = [_msg(i, days[i % 8]) for i in range(40)] + [_msg(5, days[5], "d")]
    messages = spark.createDataFrame([(m,) for m in msgs], "value string")
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/features"
    for d in days:
        jobs.daily_ingest(messages, d, raw)
    jobs.daily_ingest(messages, days[3], raw)  # re-run: unchanged
    table = spark.read.parquet(raw)
    assert table.count() == 39 and "5" not in [r[0] for r in rows(table, "Transaction ID")]
    f = jobs.daily_features(spark, raw, days[-1], out)
    assert rows(f, "user_id", "num_transactions_l1w") == [("u0", 20), ("u1", 19)]
    stored = spark.read.parquet(out)
    assert rows(stored, "user_id", "date") == [("u0", days[-1]), ("u1", days[-1])]
    with pytest.raises(dq.IncompleteInputError):
        jobs.daily_features(spark, raw, days[2], out)
    with pytest.raises(ValueError):
        jobs.daily_features(spark, raw, "2025-13-01", out)


def test_feature_timestamp_and_to_pandas(spark):
    df = spark.createDataFrame([(1,)], "n int")
    stamped = feat.with_feature_timestamp(df, dt.datetime(2025, 3, 18, 1, 2, 3))
    assert stamped.first()["feature_timestamp"] == dt.datetime(2025, 3, 18, 1, 2, 3)
    assert feat.with_feature_timestamp(df).first()["feature_timestamp"] is not None
    assert len(tb.to_pandas(df, 5)) == 1
    with pytest.raises(tb.ResultTooLarge):
        tb.to_pandas(spark.range(10), max_rows=5)
    assert tb.from_pandas(spark, tb.to_pandas(df, 1)).count() == 1


def _m(i, day, op="c", ts=None):
    return _msg(i, day, op) if ts is None else json.dumps({"payload": {
        "before": None, "after": json.loads(_msg(i, day))["payload"]["after"], "op": op,
        "source": {"ts_ms": ts, "lsn": ts}}})


def test_empty_day_is_removed(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    day = dt.date(2025, 3, 10)
    first = spark.createDataFrame([(_msg(1, day),)], "value string")
    jobs.daily_ingest(first, day, raw)
    assert spark.read.parquet(raw).count() == 1
    # the only row of the day is deleted: the re-run leaves no stale partition
    both = spark.createDataFrame([(_msg(1, day),), (_msg(1, day, "d"),)], "value string")
    jobs.daily_ingest(both, day, raw)
    import os
    assert not any(p.startswith("date=") for p in os.listdir(raw))


def test_backfill_ingest_moves_rows(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    d1, d2 = dt.date(2025, 3, 10), dt.date(2025, 3, 11)
    before = spark.createDataFrame([(_m(1, d1, ts=1),), (_m(2, d1, ts=2),)], "value string")
    jobs.backfill_ingest(before, d1, d2, raw)
    assert rows(spark.read.parquet(raw), "Transaction ID", "date") == [("1", d1), ("2", d1)]
    # row 1 is updated and now belongs to the next day
    after = spark.createDataFrame([(_m(1, d1, ts=1),), (_m(2, d1, ts=2),), (_m(1, d2, "u", ts=3),)],
                                  "value string")
    jobs.backfill_ingest(after, d1, d2, raw)
    assert rows(spark.read.parquet(raw), "Transaction ID", "date") == [("1", d2), ("2", d1)]


def test_cluster_settings():
    from tallyspark.session import cluster_settings
    big = cluster_settings(8000, 20 * (1 << 40))          # 20 TB largest shuffle
    assert big["spark.sql.shuffle.partitions"] == str(20 * (1 << 40) // (256 << 20))
    small = cluster_settings(8, 1 << 20)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert cluster_settings(8000, 1 << 50)["spark.sql.shuffle.partitions"] == str((1 << 50) // (256 << 20))


def test_window_prunes_date_partitions(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    days = [dt.date(2025, 3, 1) + dt.timedelta(days=k) for k in range(20)]
    data = [(f"u{i % 3}", str(i), float(i), "v", "s", days[i % 20]) for i in range(100)]
    df = spark.createDataFrame(data, "`User ID` string, `Transaction ID` string, Amount double, "
                                     "Vendor string, Sources string, date date")
    tb.write_partitions(df, raw)
    out = feat.window_features(spark.read.parquet(raw), dt.date(2025, 3, 15))
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(date" in scan and "2025-03-08" in scan
    assert "Transaction ID" in scan and "Time" not in scan
    assert out.count() == 3


def test_command_line(spark, tmp_dir):
    import os

    from tallyspark.__main__ import main
    days = [dt.date(2025, 3, 10) + dt.timedelta(days=k) for k in range(8)]
    msgs = f"{tmp_dir}/msgs"
    os.makedirs(msgs)
    with open(f"{msgs}/m.json", "w") as fh:
        fh.write("\n".join(_msg(i, days[i % 8]) for i in range(24)) + "\n")
    raw, out, back = f"{tmp_dir}/raw", f"{tmp_dir}/features", f"{tmp_dir}/backfill"
    for d in days:
        assert main(["ingest", "--messages", msgs, "--date", str(d), "--out", raw], spark) == 0
    assert main(["features", "--raw", raw, "--date", str(days[-1]), "--out", out], spark) == 0
    assert main(["features", "--raw", raw, "--date", str(days[1]), "--out", out], spark) == 1
    assert main(["features", "--raw", raw, "--date", "2025-3-1", "--out", out], spark) == 1
    assert main(["backfill", "--raw", raw, "--start", str(days[-2]), "--end", str(days[-1]),
                 "--out", back], spark) == 0
    stored = spark.read.parquet(back)
    assert rows(stored.where(f"date = DATE'{days[-1]}'"), "user_id", "num_transactions_l1w") == \
        rows(spark.read.parquet(out), "user_id", "num_transactions_l1w")


def test_backfill_is_gated_per_run_date(spark, tmp_dir):
    days = [dt.date(2025, 3, 1) + dt.timedelta(days=k) for k in range(10)]
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    rows_ = [("u1", str(i), 1.0, "v", "s", d) for i, d in enumerate(days)]
    schema = "`User ID` string, `Transaction ID` string, Amount double, Vendor string, Sources string, date date"
    tb.write_partitions(spark.createDataFrame(rows_, schema), raw)
    with pytest.raises(IncompleteInputError):
        jobs.backfill_feature_days(spark, raw, days[0], days[-1], out)
    jobs.backfill_feature_days(spark, raw, days[0], days[-1], out, incomplete="skip")
    got = [r[0] for r in spark.read.parquet(out).select("date").distinct().orderBy("date").collect()]
    assert got == days[6:]
    args = ["backfill", "--raw", raw, "--start", str(days[0]), "--end", str(days[-1]), "--out", out]
    assert main(args, spark) == 1
    assert main([*args, "--incomplete", "skip"], spark) == 0


def test_backfill_removes_stale_run_dates(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    days = [dt.date(2025, 3, 1) + dt.timedelta(days=k) for k in range(3)]
    schema = "`User ID` string, `Transaction ID` string, Amount double, Vendor string, Sources string, date date"
    tb.write_partitions(spark.createDataFrame([("u", "1", 1.0, "v", "s", days[0])], schema), raw)
    old = spark.createDataFrame([("u", d) for d in days], "user_id string, date date")
    tb.write_partitions(old, out)
    jobs.backfill_feature_days(spark, raw, days[1], days[2], out, days_back=0, min_dates=0)
    assert [r[0] for r in spark.read.schema("user_id string, date date").parquet(out).select("date").collect()] \
        == [days[0]]


def test_update_touches_only_its_dates(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    tb.write_partitions(spark.createDataFrame([("a", 1, d1), ("b", 2, d2), ("c", 2, d2)],
                                              "v string, n int, date date"), path)
    before = sorted(os.listdir(f"{path}/date={d1}"))
    jobs.update_table(spark, path, F.col("v") == "b", {"n": 9})
    assert rows(spark.read.parquet(path), "v", "n") == [("a", 1), ("b", 9), ("c", 2)]
    assert sorted(os.listdir(f"{path}/date={d1}")) == before
    with pytest.raises(ValueError):
        jobs.update_table(spark, path, F.col("v") == "b", {"date": d1})


def test_materialize_command(spark, tmp_dir, monkeypatch):
    from tallyspark.operators import store
    src, out = f"{tmp_dir}/features", f"{tmp_dir}/online"
    spark.createDataFrame([("u1", 1, dt.date(2025, 3, 1)), ("u1", 2, dt.date(2025, 3, 2)),
                           ("u2", 3, dt.date(2025, 3, 5))], "user_id string, n long, date date").write.parquet(src)
    who = (store.Entity("customer", ("user_id",), "key"),)
    view = store.FeatureView("counts", who, (store.Field("n", "Int64"),),
                             store.FeatureSource("src", src, "parquet", "date"))
    module = types.ModuleType("views_for_test")
    module.VIEWS = [view]
    monkeypatch.setitem(sys.modules, "views_for_test", module)
    args = ["materialize", "--views", "views_for_test:VIEWS", "--out", out, "--date"]
    assert main([*args, "2025-03-02"], spark) == 0
    assert rows(store.read_online(spark, f"{out}/counts"), "user_id", "n") == [("u1", 2)]
    assert main([*args, "2025-03-06"], spark) == 0
    assert rows(store.read_online(spark, f"{out}/counts"), "user_id", "n") == [("u1", 2), ("u2", 3)]
    history = store.get_historical_features([{"user_id": "u1", "event_timestamp": "2025-03-01 12:00:00"}],
                                            ["counts:n"], None, [view])
    assert history.first()["n"] == 1
