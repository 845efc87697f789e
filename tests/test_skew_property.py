"""Backfilled features and current-row rebuilds against brute force on random
inputs where one key holds a third of all rows."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from helpers import rows

from tallyspark.operators import changes as chg
from tallyspark.operators import features as feat

SCHEMA = ("`User ID` string, `Transaction ID` string, Amount double, Vendor string, "
          "Sources string, date date")
START = dt.date(2025, 3, 1)


def brute_backfill(data, start, end, days_back):
    out = []
    run = start
    while run <= end:
        lo = run - dt.timedelta(days=days_back)
        by_user: dict[str, list] = {}
        for r in data:
            if r[5] is not None and lo <= r[5] <= run:
                by_user.setdefault(r[0], []).append(r)
        for user, rs in by_user.items():
            amounts = [r[2] for r in rs if r[2] is not None]
            total = sum(amounts) if amounts else None
            out.append((user, sum(1 for r in rs if r[1] is not None), total,
                        total / len(amounts) if amounts else None,
                        min(amounts) if amounts else None, max(amounts) if amounts else None,
                        len({r[3] for r in rs if r[3] is not None}),
                        len({r[4] for r in rs if r[4] is not None}), run))
        run += dt.timedelta(days=1)
    return out


def close(a, b):
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, float):
                if abs(u - v) > 1e-9 * max(1.0, abs(u)):
                    return False
            elif u != v:
                return False
    return True


@pytest.mark.parametrize("seed", [11, 12])
def test_backfill_with_hot_user(spark, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(300):
        user = "hot" if rnd.random() < 1 / 3 else f"u{rnd.randrange(8)}"
        amount = None if rnd.random() < 0.05 else float(rnd.randrange(1, 10000)) / 4
        vendor = None if rnd.random() < 0.05 else f"v{rnd.randrange(12)}"
        txn = None if rnd.random() < 0.03 else str(i)
        data.append((user, txn, amount, vendor, f"s{rnd.randrange(3)}",
                     START + dt.timedelta(days=rnd.randrange(20))))
    df = spark.createDataFrame(data, SCHEMA)
    s, e = START + dt.timedelta(days=3), START + dt.timedelta(days=18)
    got = rows(feat.backfill_features(df, s, e))
    want = sorted(brute_backfill(data, s, e, 7),
                  key=lambda t: tuple((v is not None, v) for v in t))
    assert close(got, want)


def _msg(op, id_, amount, ts_ms, lsn):
    row = {"id": id_, "User ID": "u", "Transaction ID": f"t{id_}", "Amount": amount,
           "Vendor": "v", "Sources": "s", "Time": "2025-03-10 10:00:00"}
    payload = {"before": row if op == "d" else None, "after": None if op == "d" else row,
               "op": op, "source": {"ts_ms": ts_ms, "lsn": lsn}}
    return json.dumps({"payload": payload})


@pytest.mark.parametrize("seed", [21, 22])
@pytest.mark.parametrize("mode", ["any", "latest"])
def test_current_rows_with_hot_id(spark, seed, mode):
    rnd = random.Random(seed)
    changes = []
    for lsn in range(400):
        id_ = 0 if rnd.random() < 1 / 3 else rnd.randrange(1, 40)
        op = rnd.choice("cccuuud")
        changes.append((op, id_, float(lsn), rnd.randrange(50), lsn))  # ts_ms ties are common
    df = spark.createDataFrame([(_msg(*c),) for c in changes], "value string")
    got = rows(chg.current_rows(chg.parse_changes(df), deletes_mode=mode), "id", "Amount")
    newest = {}
    deleted = set()
    for op, id_, amount, ts, lsn in changes:
        if op == "d":
            deleted.add(id_)
        if mode == "any" and op == "d":
            continue
        if id_ not in newest or (ts, lsn) > newest[id_][:2]:
            newest[id_] = (ts, lsn, op, amount)
    if mode == "any":
        want = sorted((i, v[3]) for i, v in newest.items() if i not in deleted)
    else:
        want = sorted((i, v[3]) for i, v in newest.items() if v[2] != "d")
    assert got == want
