"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus import WORD, documents, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import periods


def brute_runs(w, least=6, times=4):
    n, out = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)  # the smallest period comes first
            i = j
    return sorted((a, b - a, q) for (a, b), q in out.items())


def rewritten(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain(doc_id, text):
    w = rewritten(doc_id, WORD.findall(text or ""))
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-(r[1] * 10 ** 12 // r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def found(w, part=None):
    part = np.zeros(len(w), np.int64) if part is None else part
    b, e, p = periods.find_runs(np.asarray(w, dtype=np.uint64), part)
    return list(zip(b.tolist(), (e - b).tolist(), p.tolist(), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_small_alphabets(w):
    assert found(w) == brute_runs(w)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=6))
def test_powers(blocks):
    w = [x for b, n in blocks for x in b * n]
    assert found(w) == brute_runs(w)
    cuts = np.array([0, len(w) // 3, len(w)])
    if len(w):
        b, e, p = periods.runs_of(np.asarray(w, dtype=np.uint64), cuts, 2, 2)
        want = [(a + c, n, q) for c, d in zip(cuts, cuts[1:], strict=False)
                for a, n, q in brute_runs(w[c:d], 2, 2)]
        assert sorted(zip(b.tolist(), (e - b).tolist(), p.tolist(), strict=True)) == sorted(want)


def test_no_run_crosses_documents():
    w = [1] * 10
    assert found(w, np.repeat([0, 1], 5)) == []
    assert found(w, np.repeat([0, 1], [3, 7])) == [(3, 7, 1)]


def test_long_sequences():
    rng = random.Random(4)
    w = [rng.randrange(50) for _ in range(3000)]
    w += (w[-700:] * 5)[:3200] + [7] * 5000 + [1, 2] * 2000
    b = [rng.randrange(4) for _ in range(20_000)]
    assert found(w) == brute_runs(w)
    assert found(b) == [r for r in brute_runs(b[:200]) if r[0] + r[1] < 190] + [
        r for r in found(b) if r[0] + r[1] >= 190]
    one = [3] * 200_000
    assert found(one) == [(0, 200_000, 1)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "b", "la", "Über", "x,"])
    out = [r for r in documents() if r[0] != 137]
    out += [[200 + i, "  ".join([word() for _ in range(4)] * rng.randint(1, 12) + [word()] * rng.randint(0, 9)), "s"]
            for i in range(60)]
    out += [[300 + i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 90))), "s"] for i in range(40)]
    out += [[400, "same\n" * 9, "s"], [400, "same\n" * 9, "s"], [None, "z " * 30, "s"]]
    return out


def test_equals_brute_force(spark, rows):
    got = [tuple(r) for r in periods.periodic_runs(frame(spark, rows)).collect()]
    want = [plain(i, t) for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 30
    assert periods.periodic_runs(empty(spark)).collect() == []


def test_text_over_a_chunk(spark):
    rng = random.Random(9)
    text = " ".join(f"word{rng.randrange(10 ** 6)}" for _ in range(110_000)) + " tick tock" * 3000
    assert len(text) > 1 << 20
    got = periods.periodic_runs(frame(spark, [[1, text, "s"], [2, "a", "s"]])).where("doc_id = 1").first()
    w = rewritten(1, text.split())
    assert w == text.split() and (got.n_runs, got.start, got.length, got.period) == (1, 110_000, 6000, 2)
