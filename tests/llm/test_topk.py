"""Exact inner-product search against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tallyspark.llm import pivots

SCHEMA = "vec_id long, embedding array<double>, uid long, score string, near int"


def brute(rows, wanted, k=10):
    size = {}
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for _, v in ok:
        size[len(v)] = size.get(len(v), 0) + 1
    most = min(size, key=lambda n: (-size[n], n)) if size else 0
    ok = [(i, v) for i, v in ok if len(v) == most]
    out = []
    for a, (i, q) in enumerate(ok):
        if wanted(i):
            best = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j) for b, (j, v) in enumerate(ok) if b != a)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best[:k])]
    return sorted(out)


def table(n=300, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centres[i % 6]]) for i in range(n)]
    rows += [(1000 + i, [0.5] * 8) for i in range(150)]  # a third of all rows are one vector
    rows += [(2000, [0.0] * 8), (2001, [0.0] * 8), (2010, None), (2020, []), (2030, [1.0] * 7 + [None]),
             (2040, [1.0] * 7 + [math.nan]), (2050, [math.inf] * 8), (2060, [3.0, 4.0]), (None, [1.0] * 8),
             rows[20], rows[20], (30, [9.0] * 8), (2100, [-50.0] * 8), (2101, [-1e-5] * 8)]
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows], SCHEMA).repartition(3)
    out = pivots.top_products(df, df.where("vec_id % 10 = 0"), **more)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("block", [16_384, 7])
def test_equals_brute_force(spark, block):
    rows = table()
    assert run(spark, rows, query_block=block) == brute(rows, lambda i: i % 10 == 0)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (10, [1.0, 2.0]), (7, [-1.0, 0.5])]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []


def test_bounds_spare_most_products():
    """On clustered vectors the search takes a small part of all products."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4000, (40, 16))
    x = np.floor(centres[np.arange(8000) % 40] + rng.normal(0, 60, (8000, 16)))
    x = x[np.argsort(np.arange(8000) % 40, kind="stable")]
    p = pivots.Pivots(np.arange(0, 8000, 10), x[::10], 32)
    block = pivots.Block.__new__(pivots.Block)
    block.uid, block.vec = np.arange(0, 8000, 100), x[::100].astype(np.int32)
    block.d, block.floor = p.distances(x[::100]), p.floors(np.arange(0, 8000, 100), x[::100], 10)
    best, taken = pivots.Best(block.floor, 11), 0
    for at in range(0, 8000, 1000):
        part = slice(at, at + 1000)
        taken += pivots.evaluate(block, best, x[part], p.distances(x[part]), np.arange(8000)[part],
                                 np.arange(8000)[part])
    assert taken < 0.1 * 80 * 8000
    scores = x[::100] @ x.T
    for q in range(80):
        assert best.uid[q].tolist() == sorted(range(8000), key=lambda j: (-scores[q, j], j))[:11]
