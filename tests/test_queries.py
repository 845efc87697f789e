"""Every registered query against its DuckDB twin on the smallest tables,
plus the driver's contract (entry, queries, oracle_sql)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tallyspark.operators import filters as flt
from tallyspark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    return (3, str(v))


def test_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())  # every operator of the library has its SQL twin


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = sorted(tuple(norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name, operator", [
    ("filter_date", "on_date"), ("filter_range", "in_range"), ("date_gate", "in_range"),
    ("partition_range", "in_range")])
def test_answer_depends_on_the_operator(spark, monkeypatch, name, operator):
    """With the operator switched off the rows differ: no input builder does its work."""
    right = sorted(map(str, QUERIES[name](spark, SF).collect()))
    monkeypatch.setattr(flt, operator, lambda df, *a, **k: df)
    assert sorted(map(str, QUERIES[name](spark, SF).collect())) != right


def test_weekly_features_cut_their_own_window(spark, monkeypatch):
    from tallyspark.operators import features as feat

    right = sorted(map(str, QUERIES["weekly_features"](spark, SF).collect()))
    monkeypatch.setattr(feat, "in_range", lambda df, *a, **k: df)
    assert sorted(map(str, QUERIES["weekly_features"](spark, SF).collect())) != right
