"""Near-duplicate documents, repeated strings and repeated lines against
brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import documents, empty, frame, words

from tallyspark.llm import lineruns, minhash, suffixes


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    """(id, shingles, component, kept) of each row, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return [(i, len(x), None if i is None else find(i), i is not None and find(i) == i) for i, x in sets]


def test_near_duplicates(spark):
    rows = documents()
    want = sorted(plain_components(rows), key=str)
    got = sorted((tuple(r) for r in minhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == want
    assert any(not k for *_, k in want)


def test_mixed_buckets_are_compared_whole(spark):
    """A chain of copies, each close to the next but not to the first: the
    smallest of a bucket does not link to all of its members."""
    from corpus import prose
    import random
    w = prose(random.Random(9), 400).split()
    rows = []
    for k in range(30):
        rows.append([500 - k if k % 2 else k, " ".join(w), "s"])
        for i in range(k * 12, k * 12 + 4):
            w[i] = f"new{k}x{i}"
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert set(got.values()) == {0}


def test_estimate_is_close(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    a, b = values[:2000], values[500:2500]
    both = np.concatenate([np.sort(a), np.sort(b)])
    m = minhash._minima(both, np.array([0, 2000, 4000]), minhash.FINE)
    row = minhash._packed(m, 1).view(np.int64).tolist()
    df = spark.createDataFrame([(row[0], row[1])], "x array<long>, y array<long>")
    got = df.select(minhash.estimate("x", "y", minhash.FINE, 1).alias("e")).first().e
    assert abs(got - 1500 / 2500) < 0.08


@pytest.mark.parametrize("class_size", [suffixes.CLASS, 1])
def test_repeated_strings(spark, class_size):
    rows = documents()
    width = 200
    seen = Counter()
    for _, t, _ in rows:
        b = (t or "").encode()
        seen.update(b[s:s + width] for s in range(len(b) - width + 1))
    want = []
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - width + 1):
            if seen[b[s:s + width]] > 1:
                gone[s:s + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    got = suffixes.remove_repeats(frame(spark, rows), class_size=class_size, digest=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(x[2] for x in want) > 1000
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("suffixes_")]  # nothing is left behind


def test_kept_bytes(spark):
    rows = [[1, "a" * 10 + "shared " * 40, "s"], [2, "shared " * 40 + "é", "s"]]
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(frame(spark, rows), batches=2).collect()}
    assert got == {1: b"a" * 10, 2: "é".encode()}


def _alone(line):
    found = re.findall(r"[^\W_]+", line)
    return len(found) >= 3 or sum(map(len, found)) >= 20 or len(line) >= 100


def plain_lines(rows, min_lines):
    """Deleted positions of each distinct (id, text), in the operator's order."""
    docs = sorted({(i is None, i or 0, t or "", t) for i, t, _ in rows}, key=lambda d: d[:3])
    texts = {}
    first = defaultdict(set)
    for nul, i, _, t in docs:
        part = (t or "").split("\n") if t is not None else []
        full = [(p, x) for p, x in enumerate(part) if x.strip(" ")]
        gone = set()
        for k in range(len(full)):
            for n, ok in {1: _alone(full[k][1]), min_lines: True}.items():
                run = tuple(x for _, x in full[k:k + n])
                if len(run) == n and ok:
                    if (n, run) in first:
                        gone.update(p for p, _ in full[k:k + n])
                    first[(n, run)].add(1)
        texts[nul, i, t] = (part, gone)
    return texts


@pytest.mark.parametrize("min_lines", [1, 2, 3])
def test_line_runs(spark, min_lines):
    rows = [[i, t, s] for i, t, s in documents() if i != 5]  # one text per id: the order is plain
    rows += [[200, "a\nb\nc\n\nd", "s"], [201, "x\na\nb\nc\n\nd\n", "s"], [202, "c\nd", "s"], [203, "a\nb", "s"]]
    want = plain_lines(rows, min_lines)
    got = lineruns.dedup_lines(frame(spark, rows), min_lines).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            continue
        part, gone = want[False, r.doc_id, r.text]
        runs = sum(p in gone and p - 1 not in gone for p in range(len(part)))
        assert (r.n_lines, r.n_removed, r.n_runs) == (len(part), len(gone), runs), r.doc_id
        kept = None if r.text is None else "\n".join(x for p, x in enumerate(part) if p not in gone)
        assert r.kept_text == kept
    assert set(frame(spark, rows).columns) - {"n_lines"} < set(got[0].asDict())


def test_columns_of_any_name_stay(spark):
    names = ["doc_id", "text", "__nul", "__id", "__th", "__runs", "nul", "th", "runs", "doc", "k", "lines"]
    df = spark.createDataFrame([(1, "a b c\nd", *range(10)), (2, "a b c\ne", *range(10))],
                               ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names))
    got = sorted(lineruns.dedup_lines(df).collect())
    assert got[0].__fields__ == [*names, "n_lines", "n_removed", "n_runs", "kept_text"]
    assert [r.kept_text for r in got] == ["a b c\nd", "e"] and tuple(got[1][2:12]) == tuple(range(10))


def test_short_lines_among_varied_neighbours(spark):
    """A boilerplate line goes from all but the first document, whatever stands
    beside it; braces and one-word lines stay."""
    short = ["Subscribe to our newsletter", "点击这里订阅我们的每周新闻通讯并获取最新的优惠信息"]
    spared = ["} else {", "Menu", "return x;"]
    rows = [[i, "\n".join(f"own{i}x{k}\n{line}" for k, line in enumerate(short + spared)), "s"] for i in range(4)]
    got = {r.doc_id: r for r in lineruns.dedup_lines(frame(spark, rows)).collect()}
    assert got[0].kept_text == rows[0][1] and [got[i].n_removed for i in range(4)] == [0, 2, 2, 2]
    for i in range(1, 4):
        assert got[i].kept_text.split("\n") == [x for x in rows[i][1].split("\n") if x not in short]


def test_empty_tables(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    assert suffixes.remove_repeats(empty(spark)).count() == 0
    assert lineruns.dedup_lines(empty(spark)).count() == 0
