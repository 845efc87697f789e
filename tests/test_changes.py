"""Change-feed operators on hand-written messages."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from helpers import rows

from tallyspark.operators import changes as chg
from tallyspark.sources.tables import write_partitions


def row(id_, user="u1", txn=None, amount=10.0, vendor="shop", source="Credit Card",
        time="2025-03-10 10:00:00"):
    return {"id": id_, "User ID": user, "Transaction ID": txn or f"t{id_}", "Amount": amount,
            "Vendor": vendor, "Sources": source, "Time": time}


def msg(op, before=None, after=None, ts_ms=1000, lsn=1, wrapped=True):
    payload = {"before": before, "after": after, "op": op, "ts_ms": ts_ms,
               "source": {"ts_ms": ts_ms, "lsn": lsn, "connector": "postgresql"}}
    body = {"schema": {"type": "struct"}, "payload": payload} if wrapped else payload
    return json.dumps(body)


def frame(spark, messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def test_parse_wrapped_and_bare(spark):
    df = frame(spark, [msg("c", after=row(1)), msg("c", after=row(2), wrapped=False)])
    out = chg.parse_changes(df)
    assert rows(out.select("op", "after.id"), "op", "id") == [("c", 1), ("c", 2)]


def test_parse_binary_value(spark):
    df = spark.createDataFrame([(bytearray(msg("c", after=row(1)).encode()),)], "value binary")
    assert rows(chg.parse_changes(df).select("after.id"), "id") == [(1,)]


def test_bad_messages_are_dropped(spark):
    df = frame(spark, [None, "not json", "{}", json.dumps({"schema": {}}),
                       msg("c", after=row(5))])
    out = chg.parse_changes(df)
    assert rows(out.select("after.id"), "id") == [(5,)]


def test_row_as_text(spark):
    payload = {"before": None, "after": json.dumps(row(3)), "op": "u",
               "source": {"ts_ms": 5, "lsn": 1}}
    df = frame(spark, [json.dumps({"payload": payload})])
    out = chg.parse_changes(df, row_as_text=True)
    assert rows(out.select("after.id", "after.Amount"), "id", "Amount") == [(3, 10.0)]


def changes_basic(spark):
    return chg.parse_changes(frame(spark, [
        msg("c", after=row(1, amount=1.0), ts_ms=100, lsn=1),
        msg("u", before=row(1), after=row(1, amount=2.0), ts_ms=200, lsn=2),
        msg("c", after=row(2), ts_ms=100, lsn=3),
        msg("d", before=row(2), ts_ms=300, lsn=4),
        msg("r", after=row(3, amount=3.0), ts_ms=50, lsn=5),
        msg("c", after=row(4, amount=4.0), ts_ms=60, lsn=6),
    ]))


def test_upserts_and_deletes(spark):
    ch = changes_basic(spark)
    assert rows(chg.upserts(ch).select("op", "id"), "op", "id") == [
        ("c", 1), ("c", 2), ("c", 4), ("r", 3), ("u", 1)]
    assert rows(chg.upserts(ch, ops=("c", "u")).select("id"), "id") == [(1,), (1,), (2,), (4,)]
    assert rows(chg.deletes(ch), "id") == [(2,)]


def test_current_rows_newest_version_no_deletes(spark):
    cur = chg.current_rows(changes_basic(spark))
    assert rows(cur, "id", "op", "Amount") == [(1, "u", 2.0), (3, "r", 3.0), (4, "c", 4.0)]


def test_ties_broken_by_lsn(spark):
    ch = chg.parse_changes(frame(spark, [
        msg("u", after=row(7, amount=1.0), ts_ms=500, lsn=10),
        msg("u", after=row(7, amount=2.0), ts_ms=500, lsn=11),
    ]))
    assert rows(chg.current_rows(ch), "id", "Amount") == [(7, 2.0)]


def test_delete_then_reinsert(spark):
    ch = chg.parse_changes(frame(spark, [
        msg("c", after=row(9, amount=1.0), ts_ms=100, lsn=1),
        msg("d", before=row(9), ts_ms=200, lsn=2),
        msg("c", after=row(9, amount=5.0), ts_ms=300, lsn=3),
    ]))
    # "any": a delete ever seen removes the id (the daily job's rule)
    assert chg.current_rows(ch, deletes_mode="any").count() == 0
    # "latest": the re-insert is newer than the delete
    assert rows(chg.current_rows(ch, deletes_mode="latest"), "id", "Amount") == [(9, 5.0)]


def test_null_id_and_bad_time(spark):
    ch = chg.parse_changes(frame(spark, [
        msg("c", after=row(None), ts_ms=1, lsn=1),
        msg("c", after=row(11, time="yesterday"), ts_ms=1, lsn=2),
        msg("c", after=row(12), ts_ms=1, lsn=3),
    ]))
    day = chg.ingest_day(ch, "2025-03-10")
    assert rows(day, "Transaction ID") == [("t12",)]


def test_ingest_day_uses_newest_version_for_the_day(spark):
    # an update moves the row from 03-10 to 03-11: it belongs to 03-11 only
    ch = chg.parse_changes(frame(spark, [
        msg("c", after=row(20, time="2025-03-10 09:00:00"), ts_ms=1, lsn=1),
        msg("u", after=row(20, time="2025-03-11 09:00:00"), ts_ms=2, lsn=2),
        msg("c", after=row(21, time="2025-03-10 12:00:00"), ts_ms=1, lsn=3),
    ]))
    d10 = chg.ingest_day(ch, "2025-03-10")
    d11 = chg.ingest_day(ch, dt.date(2025, 3, 11))
    assert rows(d10, "Transaction ID") == [("t21",)]
    assert rows(d11, "Transaction ID") == [("t20",)]
    assert d10.columns == ["op", "User ID", "Transaction ID", "Amount", "Vendor", "Sources",
                           "Time", "date"]


def test_ingest_day_rejects_bad_date(spark):
    with pytest.raises(ValueError):
        chg.ingest_day(changes_basic(spark), "2025/03/10")


def test_rerun_of_a_day_is_idempotent(spark, tmp_dir):
    ch = chg.parse_changes(frame(spark, [
        msg("c", after=row(30, time="2025-03-10 09:00:00"), ts_ms=1, lsn=1),
        msg("c", after=row(31, time="2025-03-11 09:00:00"), ts_ms=1, lsn=2),
    ]))
    path = f"{tmp_dir}/daily"
    write_partitions(chg.ingest_day(ch, "2025-03-10"), path)
    write_partitions(chg.ingest_day(ch, "2025-03-11"), path)
    first = rows(spark.read.parquet(path), "Transaction ID", "date")
    write_partitions(chg.ingest_day(ch, "2025-03-10"), path)
    again = rows(spark.read.parquet(path), "Transaction ID", "date")
    assert first == again == [("t30", dt.date(2025, 3, 10)), ("t31", dt.date(2025, 3, 11))]
    # an empty day changes nothing
    write_partitions(chg.ingest_day(ch, "2025-03-12"), path)
    assert rows(spark.read.parquet(path), "Transaction ID", "date") == first


def test_combine_feed_and_snapshot(spark):
    feed = spark.createDataFrame([("t1", 1.0, dt.datetime(2025, 1, 1, 10))],
                                 "`Transaction ID` string, Amount double, timestamp timestamp")
    snap = spark.createDataFrame([(1, "t1", 2.0, dt.datetime(2025, 1, 1, 11)),
                                  (2, "t2", 3.0, dt.datetime(2025, 1, 1, 9))],
                                 "id int, `Transaction ID` string, Amount double, timestamp timestamp")
    union = chg.union_feeds(feed, snap)
    assert union.count() == 3 and "id" in union.columns
    out = chg.combine(feed, snap, "Transaction ID")
    assert rows(out, "Transaction ID", "Amount") == [("t1", 2.0), ("t2", 3.0)]


def test_envelope_time_when_source_is_missing(spark):
    def bare(op, id_, amount, ts):
        return json.dumps({"payload": {"before": None, "after": row(id_, amount=amount), "op": op,
                                       "ts_ms": ts}})
    ch = chg.parse_changes(frame(spark, [bare("c", 40, 1.0, 100), bare("u", 40, 2.0, 200)]))
    assert rows(chg.current_rows(ch), "id", "Amount") == [(40, 2.0)]


def test_ids_beyond_32_bits_and_changes_without_id(spark):
    import json
    def msg(i, op="c"):
        return (json.dumps({"payload": {"after": {"id": i, "Time": "2025-03-01 00:00:00"}, "op": op,
                                        "source": {"ts_ms": 1, "lsn": 1}}}),)
    parsed = chg.parse_changes(spark.createDataFrame([msg(3_000_000_000), msg(None), msg(None, "u")], "value string"))
    assert [r.id for r in chg.current_rows(parsed).collect()] == [3_000_000_000]
    assert rows(chg.changes_without_id(parsed)) == [("c", 1), ("u", 1)]
