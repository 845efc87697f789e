"""As-of join against a brute-force answer on random inputs, including a hot
key that holds a third of all rows and several bucket widths."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tallyspark.operators.store import asof_join

BASE = dt.datetime(2025, 3, 1)


def brute(entity, feats, ttl):
    out = []
    for key, ts in entity:
        best = None
        for fk, fts, val in feats:
            if fk == key and fts <= ts and (ttl is None or fts >= ts - ttl):
                if best is None or (fts, val) > (best[0], best[1]):
                    best = (fts, val)
        out.append((key, ts, None if best is None else best[1]))
    return sorted(out, key=lambda r: (r[0], r[1], r[2] is not None, r[2]))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bucket", [3600, 86400, 86400 * 7])
def test_asof_matches_brute_force(spark, seed, bucket):
    rnd = random.Random(seed)
    keys = ["hot"] + [f"k{i}" for i in range(6)]

    def key():
        return "hot" if rnd.random() < 1 / 3 else rnd.choice(keys[1:])

    def when():
        return BASE + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))

    feats = [(key(), when(), rnd.randrange(100)) for _ in range(120)]
    # exact ties between feature and entity timestamps
    entity = [(key(), when()) for _ in range(150)] + [(k, t) for k, t, _ in feats[:10]]
    entity += entity[:5]  # duplicate entity rows
    ttl = dt.timedelta(days=2) if seed == 3 else None
    edf = spark.createDataFrame(entity, "user_id string, event_timestamp timestamp")
    fdf = spark.createDataFrame(feats, "user_id string, ts timestamp, v int")
    got = asof_join(edf, fdf, ["user_id"], "event_timestamp", "ts", ["v"], ttl=ttl,
                    bucket_seconds=bucket)
    got = sorted(((r[0], r[1], r[2]) for r in got.collect()),
                 key=lambda r: (r[0], r[1], r[2] is not None, r[2]))
    assert got == brute(entity, feats, ttl)


@pytest.mark.parametrize("step", [1, 40_000, 0])
def test_heavy_day_is_cut_into_parts(spark, step):
    """A third of all rows lie in one (key, day), in seconds apart or all at
    one instant; the answers are those of brute force."""
    rnd = random.Random(step)
    other = lambda: BASE + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))
    hot = lambda i: BASE + dt.timedelta(days=3, milliseconds=i * step)
    entity = [("hot", hot(2 * i)) for i in range(400)] + [(f"k{i % 9}", other()) for i in range(700)]
    feats = [("hot", hot(2 * i + 1 - i % 3), i) for i in range(0, 400, 4)] + [
        (rnd.choice(["hot", "k1", "k2"]), other(), rnd.randrange(99)) for i in range(150)]
    edf = spark.createDataFrame(entity, "user_id string, event_timestamp timestamp")
    fdf = spark.createDataFrame(feats, "user_id string, ts timestamp, v int")
    got = asof_join(edf, fdf, ["user_id"], "event_timestamp", "ts", ["v"], heavy=50)
    assert sorted(((r[0], r[1], r[2]) for r in got.collect()),
                  key=lambda r: (r[0], r[1], r[2] is not None, r[2])) == brute(entity, feats, None)


def test_parts_of_a_heavy_day_are_small(spark):
    from pyspark.sql import functions as F

    from tallyspark.operators import store
    hot = [("hot", BASE + dt.timedelta(seconds=i)) for i in range(0, 86400, 20)]
    rows = hot + [(f"k{i % 50}", BASE + dt.timedelta(minutes=i)) for i in range(2 * len(hot))]
    df = spark.createDataFrame(rows, "__k0 string, ts timestamp").select(
        "__k0", store._slot(F.col("ts"), 86400).alias("__slot"))
    parts = store._heavy_parts(df, ["__k0"], 300)
    assert [r["__k0"] for r in parts.collect()] == ["hot"]
    sizes = [r["count"] for r in store._in_parts(df, parts, ["__k0"]).groupBy("__k0", "__b").count().collect()]
    assert max(sizes) <= 300 < len(hot)  # of 12,960 rows, 4,320 of them in one (key, day)
    assert store._heavy_parts(df, ["__k0"], 10_000).count() == 0
