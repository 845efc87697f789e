"""Feature views, as-of joins, online table and materialization."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyspark.operators import store
from tallyspark.operators.store import Entity, FeatureSource, FeatureView, Field

CUSTOMER = Entity("customer", ("user_id",))
FIELDS = (Field("num_transactions_l1w", "Int64"), Field("total_amount_l1w", "Float32"),
          Field("avg_amount_l1w", "Float32"), Field("min_amount_l1w", "Float32"),
          Field("max_amount_l1w", "Float32"), Field("num_vendors_l1w", "Int64"),
          Field("num_sources_l1w", "Int64"))
SRC = FeatureSource("transaction_source", None, "parquet", "date")
VIEW = FeatureView("customer_features", (CUSTOMER,), FIELDS, SRC)
FT_SCHEMA = ("user_id string, num_transactions_l1w long, total_amount_l1w double, "
             "avg_amount_l1w double, min_amount_l1w double, max_amount_l1w double, "
             "num_vendors_l1w long, num_sources_l1w long, date date")


def features_three(spark):
    day = dt.date(2024, 5, 11)
    return spark.createDataFrame([
        ("north", 5, 71.5, 14.3, 2.5, 41.0, 4, 1, day),
        ("south", 1, 8.25, 8.25, 8.25, 8.25, 1, 1, day),
        ("west", 6, 93.0, 15.5, 0.5, 60.0, 3, 2, day),
    ], FT_SCHEMA)


def test_projection_casts_to_view_types(spark):
    df = features_three(spark).withColumn("total_amount_l1w", F.lit(60.1))
    out = VIEW.project(df)
    assert out.columns == ["user_id", "date"] + [f.name for f in FIELDS]
    assert dict(out.dtypes)["total_amount_l1w"] == "float"
    v = out.where("user_id = 'north'").first()["total_amount_l1w"]
    assert v != 60.1 and abs(v - 60.1) < 1e-5


def test_validate(spark):
    ok = rows(VIEW.validate(features_three(spark)), "column", "present", "castable")
    assert all(p and c for _, p, c in ok) and len(ok) == 9
    bad = VIEW.validate(features_three(spark).drop("num_sources_l1w"))
    assert rows(bad.where("NOT present"), "column") == [("num_sources_l1w",)]


def test_resolve_errors():
    assert store.resolve(["customer_features:avg_amount_l1w"], [VIEW])[0][1] == "avg_amount_l1w"
    with pytest.raises(ValueError):
        store.resolve(["avg_amount_l1w"], [VIEW])
    with pytest.raises(KeyError):
        store.resolve(["nope:avg_amount_l1w"], [VIEW])
    with pytest.raises(KeyError):
        store.resolve(["customer_features:nope"], [VIEW])


def asof_features(spark):
    return spark.createDataFrame([
        ("u1", 1, 10.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 3, 10)),
        ("u1", 2, 20.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 3, 12)),
        ("u1", 3, 30.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 3, 20)),
        ("u2", 7, 70.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 3, 1)),
    ], FT_SCHEMA)


def test_asof_edges(spark):
    entity = spark.createDataFrame([
        ("u1", "2025-03-09 23:59:59"),   # before the first feature row
        ("u1", "2025-03-10 00:00:00"),   # equal to a feature timestamp
        ("u1", "2025-03-15 12:00:00"),   # between, several buckets later
        ("u1", "2025-03-15 12:00:00"),   # duplicate entity row survives
        ("u1", "2025-04-30 00:00:00"),   # long after the last
        ("u9", "2025-03-15 00:00:00"),   # unknown key
        ("u2", None),                    # no timestamp
    ], "user_id string, event_timestamp string")
    refs = ["customer_features:num_transactions_l1w", "customer_features:total_amount_l1w"]
    out = store.get_historical_features(entity, refs, {"customer_features": asof_features(spark)},
                                        [VIEW])
    assert out.columns == ["user_id", "event_timestamp", "num_transactions_l1w", "total_amount_l1w"]
    assert dict(out.dtypes)["event_timestamp"] == "timestamp"
    got = sorted((r[0], str(r[1]), r[2]) for r in out.collect())
    assert got == sorted([
        ("u1", "2025-03-09 23:59:59", None),
        ("u1", "2025-03-10 00:00:00", 1),
        ("u1", "2025-03-15 12:00:00", 2),
        ("u1", "2025-03-15 12:00:00", 2),
        ("u1", "2025-04-30 00:00:00", 3),
        ("u9", "2025-03-15 00:00:00", None),
        ("u2", "None", None),
    ])


def test_asof_ttl_edge(spark):
    view = FeatureView("customer_features", (CUSTOMER,), FIELDS, SRC, ttl=dt.timedelta(days=2))
    entity = spark.createDataFrame([
        ("u1", dt.datetime(2025, 3, 14, 0, 0, 0)),   # exactly ttl after 03-12: kept
        ("u1", dt.datetime(2025, 3, 14, 0, 0, 1)),   # one second past ttl: null
        ("u2", dt.datetime(2025, 3, 2, 0, 0, 0)),
    ], "user_id string, event_timestamp timestamp")
    out = store.get_historical_features(entity, ["customer_features:num_transactions_l1w"],
                                        {"customer_features": asof_features(spark)}, [view])
    got = sorted((r[0], str(r[1]), r[2]) for r in out.collect())
    assert got == [("u1", "2025-03-14 00:00:00", 2), ("u1", "2025-03-14 00:00:01", None),
                   ("u2", "2025-03-02 00:00:00", 7)]


def test_asof_small_buckets_equal_large(spark):
    entity = spark.createDataFrame([("u1", dt.datetime(2025, 3, d, h)) for d in range(8, 25)
                                    for h in (0, 13)], "user_id string, event_timestamp timestamp")
    refs = ["customer_features:total_amount_l1w"]
    srcs = {"customer_features": asof_features(spark)}
    a = store.get_historical_features(entity, refs, srcs, [VIEW], bucket_seconds=3600)
    b = store.get_historical_features(entity, refs, srcs, [VIEW], bucket_seconds=86400 * 30)
    assert rows(a) == rows(b)


def test_multi_view_with_untimed_view(spark):
    demo = FeatureView("demo", (CUSTOMER,), (Field("location", "String"),),
                       FeatureSource("demo_src", None, "parquet", None), online=False)
    entity = spark.createDataFrame([("u1", "2025-03-11 00:00:00"), ("u3", "2025-03-11 00:00:00")],
                                   "user_id string, event_timestamp string")
    demo_df = spark.createDataFrame([("u1", "Hanoi"), ("u2", "Hue")], "user_id string, location string")
    out = store.get_historical_features(
        entity, ["demo:location", "customer_features:num_transactions_l1w"],
        {"customer_features": asof_features(spark), "demo": demo_df}, [VIEW, demo])
    assert out.columns == ["user_id", "event_timestamp", "location", "num_transactions_l1w"]
    assert rows(out, "user_id", "location", "num_transactions_l1w") == [
        ("u1", "Hanoi", 1), ("u3", None, None)]
    named = store.get_historical_features(
        entity, ["customer_features:num_transactions_l1w"],
        {"customer_features": asof_features(spark)}, [VIEW], full_feature_names=True)
    assert named.columns[-1] == "customer_features__num_transactions_l1w"


def test_materialize_never_goes_back(spark, tmp_dir):
    root = f"{tmp_dir}/online"
    newer = asof_features(spark)
    store.materialize(spark, VIEW, root, dt.date(2025, 3, 31), newer)
    first = rows(store.read_online(spark, root), "user_id", "num_transactions_l1w", "date")
    assert first == [("u1", 3, dt.date(2025, 3, 20)), ("u2", 7, dt.date(2025, 3, 1))]
    # a late, older row for u1 arrives in the next slice: it must not win
    late = spark.createDataFrame([("u1", 99, 1.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 3, 5)),
                                  ("u3", 5, 1.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 4, 2))], FT_SCHEMA)
    store.materialize(spark, VIEW, root, dt.date(2025, 4, 30), late, start=None)
    second = rows(store.read_online(spark, root), "user_id", "num_transactions_l1w")
    assert second == [("u1", 3), ("u2", 7), ("u3", 5)]
    offline = FeatureView("x", (CUSTOMER,), FIELDS, SRC, online=False)
    assert store.materialize(spark, offline, f"{tmp_dir}/none", dt.date(2025, 4, 30), late) is None
    # a run for an earlier end adds its rows and does not move the remembered end back
    early = spark.createDataFrame([("u9", 4, 1.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 1, 5))], FT_SCHEMA)
    store.materialize(spark, VIEW, root, dt.date(2025, 1, 20), early, start=None)
    assert rows(store.read_online(spark, root), "user_id") == [("u1",), ("u2",), ("u3",), ("u9",)]
    assert store.stored_end(spark, root) == dt.datetime(2025, 4, 30)
    assert rows(store.materialization_runs(spark, root), "run", "end")[-1] == (3, dt.datetime(2025, 1, 20))
    # an empty slice changes nothing, and the run is remembered
    assert store.materialize(spark, VIEW, root, dt.date(2025, 6, 1), early) == 4
    assert rows(store.read_online(spark, root), "user_id") == [("u1",), ("u2",), ("u3",), ("u9",)]
    assert store.stored_end(spark, root) == dt.datetime(2025, 6, 1)


@pytest.mark.parametrize("corrected", [3, 8])
def test_correction_of_a_day_reaches_the_online_table(spark, tmp_dir, corrected):
    """Downward or upward: a re-run for the same end reads its slice again."""
    root, day = f"{tmp_dir}/online", dt.date(2025, 1, 20)
    def feed(n, more=()):
        return spark.createDataFrame([("u1", n, 1.0, 1.0, 1.0, 1.0, 1, 1, day), *more], FT_SCHEMA)
    store.materialize(spark, VIEW, root, dt.date(2025, 1, 19), feed(5))
    store.materialize(spark, VIEW, root, day, feed(5))
    store.materialize(spark, VIEW, root, day, feed(corrected))
    got = rows(store.read_online(spark, root), "user_id", "num_transactions_l1w", store.RUN)
    assert got == [("u1", corrected, 3)]
    # a later day wins over a correction of the earlier one that comes after it
    later = ("u1", 1, 1.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 1, 21))
    store.materialize(spark, VIEW, root, dt.date(2025, 1, 21), feed(corrected, [later]))
    store.materialize(spark, VIEW, root, day, feed(77, [later]))
    assert rows(store.read_online(spark, root), "num_transactions_l1w", store.RUN) == [(1, 4)]
    slices = rows(store.materialization_runs(spark, root), "run", "start", "end")
    assert slices[-1] == (5, dt.datetime(2025, 1, 19), dt.datetime(2025, 1, 20))


def test_incremental_slices(spark):
    df = asof_features(spark)
    first = store.online_rows(VIEW, df, end=dt.date(2025, 3, 12))
    second = store.online_rows(VIEW, df, start=dt.date(2025, 3, 12), end=dt.date(2025, 3, 31))
    merged = store.merge_online(first, second, ["user_id"], "date")
    full = store.online_rows(VIEW, df, end=dt.date(2025, 3, 31))
    assert rows(merged) == rows(full)


def test_online_lookup_unknown_key(spark):
    online = store.online_rows(VIEW, asof_features(spark))
    keys = spark.createDataFrame([("u1",), ("u9",), ("u1",)], "user_id string")
    out = store.get_online_features({"customer_features": online}, keys,
                                    ["customer_features:total_amount_l1w",
                                     "customer_features:num_transactions_l1w"], [VIEW])
    assert out.columns == ["user_id", "total_amount_l1w", "num_transactions_l1w"]
    assert rows(out) == [("u1", 30.0, 3), ("u1", 30.0, 3), ("u9", None, None)]


def test_entity_rows_as_list_and_pandas(spark):
    import pandas as pd
    online = store.online_rows(VIEW, asof_features(spark))
    out = store.get_online_features({"customer_features": online}, [{"user_id": "u2"}],
                                    ["customer_features:num_transactions_l1w"], [VIEW])
    assert rows(out) == [("u2", 7)]
    pdf = pd.DataFrame([{"user_id": "u1", "event_timestamp": "2025-03-18"}])
    hist = store.get_historical_features(pdf, ["customer_features:num_transactions_l1w"],
                                         {"customer_features": asof_features(spark)}, [VIEW])
    assert [r["num_transactions_l1w"] for r in hist.collect()] == [2]


def test_availability_delay(spark):
    entity = spark.createDataFrame([("u1", "2025-03-12 12:00:00"), ("u1", "2025-03-13 00:00:00")],
                                   "user_id string, event_timestamp string")
    refs = ["customer_features:num_transactions_l1w"]
    srcs = {"customer_features": asof_features(spark)}
    plain = store.get_historical_features(entity, refs, srcs, [VIEW])
    assert rows(plain, "num_transactions_l1w") == [(2,), (2,)]
    delayed = FeatureView("customer_features", (CUSTOMER,), FIELDS, SRC,
                          availability_delay=dt.timedelta(days=1))
    out = store.get_historical_features(entity, refs, srcs, [delayed])
    # the row dated 03-12 is visible from 03-13 00:00 only
    got = sorted((str(r[1]), r[2]) for r in out.collect())
    assert got == [("2025-03-12 12:00:00", 1), ("2025-03-13 00:00:00", 2)]
    online = store.online_rows(delayed, asof_features(spark), end=dt.datetime(2025, 3, 20, 12))
    assert rows(online, "user_id", "num_transactions_l1w") == [("u1", 2), ("u2", 7)]


def test_null_keys_never_match(spark):
    feats = asof_features(spark).unionByName(spark.createDataFrame(
        [(None, 5, 1.0, 1.0, 1.0, 1.0, 1, 1, dt.date(2025, 3, 1))], FT_SCHEMA))
    entity = spark.createDataFrame([(None, "2025-03-15 00:00:00"), ("u2", "2025-03-15 00:00:00")],
                                   "user_id string, event_timestamp string")
    out = store.get_historical_features(entity, ["customer_features:num_transactions_l1w"],
                                        {"customer_features": feats}, [VIEW])
    assert rows(out, "user_id", "num_transactions_l1w") == [(None, None), ("u2", 7)]


def test_untimed_view_never_multiplies_entity_rows(spark):
    demo = FeatureView("demo", (CUSTOMER,), (Field("location", "String"),),
                       FeatureSource("demo_src", None, "parquet", None), online=False)
    demo_df = spark.createDataFrame([("u1", "Hanoi"), ("u1", "Hue"), (None, "x")],
                                    "user_id string, location string")
    entity = spark.createDataFrame([("u1", "2025-03-11 00:00:00")] * 3,
                                   "user_id string, event_timestamp string")
    out = store.get_historical_features(entity, ["demo:location"], {"demo": demo_df}, [demo])
    assert rows(out, "user_id", "location") == [("u1", "Hue")] * 3


def test_untimed_view_cannot_be_materialized(spark):
    demo = FeatureView("demo", (CUSTOMER,), (Field("location", "String"),),
                       FeatureSource("demo_src", None, "parquet", None))
    with pytest.raises(ValueError):
        store.online_rows(demo, spark.createDataFrame([("u1", "x")], "user_id string, location string"))


def test_equal_feature_names_are_refused(spark):
    other = FeatureView("other", (CUSTOMER,), FIELDS, SRC)
    entity = spark.createDataFrame([("u1", dt.datetime(2025, 3, 15))], "user_id string, event_timestamp timestamp")
    refs = ["customer_features:num_vendors_l1w", "other:num_vendors_l1w"]
    tables = {"customer_features": asof_features(spark), "other": asof_features(spark)}
    with pytest.raises(ValueError, match="used twice"):
        store.get_historical_features(entity, refs, tables, [VIEW, other])
    both = store.get_historical_features(entity, refs, tables, [VIEW, other], full_feature_names=True)
    assert both.columns[-2:] == ["customer_features__num_vendors_l1w", "other__num_vendors_l1w"]
    with pytest.raises(ValueError, match="used twice"):
        store.get_historical_features(entity.withColumn("num_vendors_l1w", F.lit(1)), refs[:1], tables, [VIEW])


def test_rows_without_key_or_time_keep_their_place(spark):
    entity = spark.createDataFrame(
        [("u1", dt.datetime(2025, 3, 25)), (None, dt.datetime(2025, 3, 25)), ("u1", None), (None, None)],
        "user_id string, event_timestamp timestamp")
    got = store.get_historical_features(entity, ["customer_features:num_transactions_l1w"],
                                        {"customer_features": asof_features(spark)}, [VIEW])
    assert got.count() == 4 and got.where("num_transactions_l1w is not null").count() == 1


def test_check_values(spark):
    view = FeatureView("t", (CUSTOMER,), (Field("a", "Int64"), Field("b", "String")), SRC)
    df = spark.createDataFrame([("u", "1", "x"), ("v", "x", None), (None, None, "y")],
                               "user_id string, a string, b string")
    assert rows(store.check_values(df, view), "column", "n_rows", "n_null", "n_uncastable") == [
        ("a", 3, 1, 1), ("b", 3, 1, 0), ("user_id", 3, 1, 0)]
