"""Feature aggregates, gates and comparisons on hand-written rows."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyspark.operators import features as feat
from tallyspark.operators import quality as dq

SCHEMA = ("`User ID` string, `Transaction ID` string, Amount double, Vendor string, "
          "Sources string, date date")
RUN = dt.date(2025, 3, 17)


def d(n):
    return RUN + dt.timedelta(days=n)


def window_edges(spark):
    return spark.createDataFrame([
        ("a", "1", 10.0, "v1", "s1", d(-8)),   # outside: run - 8
        ("a", "2", 20.0, "v1", "s1", d(-7)),   # inside: run - 7 (both ends included)
        ("a", "3", 30.0, "v2", "s2", d(0)),    # inside: run
        ("a", "4", 40.0, "v3", "s3", d(1)),    # outside: run + 1
        ("b", "5", 5.0, "v1", "s1", d(-3)),
    ], SCHEMA)


def test_window_closed_range_of_eight_days(spark):
    out = feat.window_features(window_edges(spark), RUN)
    assert out.columns == ["user_id", "num_transactions_l1w", "total_amount_l1w", "avg_amount_l1w",
                           "min_amount_l1w", "max_amount_l1w", "num_vendors_l1w",
                           "num_sources_l1w", "date"]
    assert rows(out) == [
        ("a", 2, 50.0, 25.0, 20.0, 30.0, 2, 2, RUN),
        ("b", 1, 5.0, 5.0, 5.0, 5.0, 1, 1, RUN),
    ]


def test_window_true_week(spark):
    out = feat.window_features(window_edges(spark), RUN, days_back=6)
    assert rows(out, "user_id", "num_transactions_l1w") == [("a", 1), ("b", 1)]


def test_window_nulls(spark):
    df = spark.createDataFrame([
        ("a", None, 10.0, "v1", "s1", RUN),
        ("a", "2", None, None, "s1", RUN),
        ("a", "3", 30.0, "v1", None, RUN),
        ("c", "4", None, None, None, RUN),
    ], SCHEMA)
    out = feat.window_features(df, RUN)
    # count skips null ids; sum/avg/min/max skip null amounts; distinct skips nulls
    assert rows(out) == [
        ("a", 2, 40.0, 20.0, 10.0, 30.0, 1, 1, RUN),
        ("c", 1, None, None, None, None, 0, 0, RUN),
    ]


def test_decimal_amounts_give_doubles(spark):
    df = spark.createDataFrame([("a", "1", 0.1, "v", "s", RUN), ("a", "2", 0.2, "v", "s", RUN)],
                               SCHEMA).withColumn("Amount", F.col("Amount").cast("decimal(18,2)"))
    out = feat.window_features(df, RUN).first()
    assert out["total_amount_l1w"] == 0.3 and isinstance(out["avg_amount_l1w"], float)


def test_collect_set_variant_equals_exact(spark):
    df = window_edges(spark)
    a = feat.aggregate_features(df, distinct="exact")
    b = feat.aggregate_features(df, distinct="set")
    assert rows(a) == rows(b)


def test_backfill_equals_single_runs(spark):
    df = window_edges(spark).unionByName(spark.createDataFrame([
        ("b", "6", 7.0, "v2", "s1", d(-1)), ("c", "7", 1.0, "v9", "s9", d(2)),
    ], SCHEMA))
    start, end = d(-2), d(3)
    back = feat.backfill_features(df, start, end)
    singles = None
    day = start
    while day <= end:
        one = feat.window_features(df, day)
        singles = one if singles is None else singles.unionByName(one)
        day += dt.timedelta(days=1)
    assert rows(back) == rows(singles)


@pytest.mark.parametrize("days_back", [0, 1, 7])
def test_backfill_intervals_equal_brute_force(spark, days_back):
    """Gaps of every length between a value's days, nulls in every column."""
    import random
    rng = random.Random(days_back)
    pick = lambda *xs: rng.choice(xs)
    data = [(pick("a", "b", None), pick("t", None), pick(1.0, 2.5, None), pick("v1", "v2", "v3", None),
             pick("s1", None), pick(*[d(n) for n in range(-40, 5)], None)) for _ in range(120)]
    start, end = d(-25), d(3)
    got = feat.backfill_features(spark.createDataFrame(data, SCHEMA), start, end, days_back=days_back)
    want = []
    for n in range((end - start).days + 1):
        run = start + dt.timedelta(days=n)
        for key in ("a", "b", None):
            w = [r for r in data if r[0] == key and r[5] and run - dt.timedelta(days=days_back) <= r[5] <= run]
            if w:
                a = [r[2] for r in w if r[2] is not None]
                want.append((key, sum(r[1] is not None for r in w), sum(a) if a else None,
                             sum(a) / len(a) if a else None, min(a, default=None), max(a, default=None),
                             len({r[3] for r in w} - {None}), len({r[4] for r in w} - {None}), run))
    assert rows(got) == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))


def test_gate_raises_on_few_dates(spark):
    df = spark.createDataFrame([("a", str(i), 1.0, "v", "s", d(-i)) for i in range(6)], SCHEMA)
    with pytest.raises(dq.IncompleteInputError):
        dq.require_dates(df, 7)
    assert dq.require_dates(df, 6) == 6


def test_gate_of_every_run_date(spark):
    days = [d(n) for n in (-9, -8, -7, -5, -3, -2, -1, 0, 0, 2)]
    df = spark.createDataFrame([("a", "1", 1.0, "v", "s", x) for x in days] + [("a", "1", 1.0, "v", "s", None)], SCHEMA)
    got = rows(dq.gate_dates(df, d(-3), d(4), days_back=7, n=6), "date", "n_dates", "complete")
    want = []
    for n in range(-3, 5):
        k = len({x for x in days if d(n - 7) <= x <= d(n)})
        want.append((d(n), k, k >= 6))
    assert got == want and len({c for *_, c in got}) == 2
    with pytest.raises(ValueError):
        dq.gate_dates(df, "2025-3-1", d(0))


def test_distinct_dates_and_row_count(spark):
    df = window_edges(spark)
    assert rows(dq.distinct_dates(df)) == [(d(-8),), (d(-7),), (d(-3),), (d(0),), (d(1),)]
    assert dq.row_count(df).first()["n_rows"] == 5


def test_compare_features(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 2, 2.0), ("z", 3, 3.0)], "user_id string, n long, m double")
    b = spark.createDataFrame([("x", 1, 1.0004), ("y", 5, 2.0), ("w", 1, 1.0)], "user_id string, n long, m double")
    out = dq.compare_features(a, b, ["user_id"], exact=["n"], approx=["m"], tol=1e-3)
    assert rows(out) == [
        ("w", False, True, 2, False),
        ("x", True, True, 0, True),
        ("y", True, True, 1, False),
        ("z", True, False, 2, False),
    ]


def test_calendar_week_and_month(spark):
    df = spark.createDataFrame([
        ("BTC", dt.date(2025, 1, 6), 10.0), ("BTC", dt.date(2025, 1, 7), 20.0),
        ("BTC", dt.date(2025, 1, 13), 30.0), ("ETH", dt.date(2024, 1, 8), 5.0),
    ], "symbol string, agg_date date, price double")
    m = {"avg_price": ("avg", "price"), "volume": ("sum", "price"), "n": ("count", "price")}
    wk = feat.calendar_features(df, "symbol", "agg_date", "week", m)
    assert rows(wk) == [("BTC", 2, 15.0, 30.0, 2), ("BTC", 3, 30.0, 30.0, 1), ("ETH", 2, 5.0, 5.0, 1)]
    tr = feat.calendar_features(df, "symbol", "agg_date", "week", m, bucket="trunc")
    assert rows(tr, "symbol", "week_start") == [
        ("BTC", dt.date(2025, 1, 6)), ("BTC", dt.date(2025, 1, 13)), ("ETH", dt.date(2024, 1, 8))]
    mo = feat.calendar_features(df, "symbol", "agg_date", "month", m)
    assert rows(mo, "symbol", "month", "n") == [("BTC", 1, 3), ("ETH", 1, 1)]


def test_keep_last_and_latest_per_key(spark):
    df = spark.createDataFrame([("u1", 1, "a"), ("u1", 3, "b"), ("u1", 2, "c"), ("u2", 1, "d")],
                               "user_id string, seq int, v string")
    assert rows(feat.keep_last(df, ["user_id"], ["seq"])) == [("u1", 3, "b"), ("u2", 1, "d")]
    assert rows(feat.latest_per_key(df, ["user_id"], "seq", start=1, end=2)) == [("u1", 2, "c")]
    tied = df.union(spark.createDataFrame([("u1", 3, "z"), ("u1", 3, None)], df.schema))
    assert rows(feat.latest_per_key(tied, ["user_id"], "seq")) == [("u1", 3, "z"), ("u2", 1, "d")]
