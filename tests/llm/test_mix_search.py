"""Mixing, decontamination, neighbours and token counts against plain code."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus import WORD, documents, empty, frame, lower
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import ann, bpe, mixing, wumanber


def plain_mix(rows):
    """(id, source, size, source size, target, taken) of each row."""
    size = lambda t: len(WORD.findall(t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    out, prior = [], dict.fromkeys(order, 0)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    key = lambda r: (md5(f"{'' if r[0] is None else r[0]}:{md5(r[1] or '')}"), r[0] or 0, size(r[1]))
    for i, t, s in sorted(rows, key=key):
        budget = math.floor(target[s] + 1e-9)
        epochs = budget // sizes[s] if sizes[s] else 0
        part = max(0, min(size(t), budget - epochs * sizes[s] - prior[s]))
        out.append((i, s, size(t), sizes[s], round(target[s], 6), epochs * size(t) + part))
        prior[s] += size(t)
    return out


def test_mix(spark):
    rows = documents()
    got = mixing.mix(frame(spark, rows)).collect()
    again = mixing.mix(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    want = plain_mix(rows)
    assert sorted(((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str) \
        == sorted(want, key=str)
    assert all(0 <= r.taken <= 2 * r.size for r in got)


def test_hot_ids_are_spread(spark):
    """A third of the rows without an id, a third with one id: their keys differ with their texts."""
    rows = [[None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text {k} " * (k % 5 + 1), "s"] for k in range(300)]
    sized = mixing.sized(frame(spark, rows)).collect()
    assert len({r.key for r in sized}) == 300 and len({r.key[:1] for r in sized if r.doc_id is None}) > 10
    got = mixing.mix(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in got) == sorted(
        (str(i), n, taken) for i, _, n, _, _, taken in plain_mix(rows))


def test_mix_keeps_columns_and_handles_nothing(spark):
    docs = frame(spark, documents()[:5])
    out = mixing.mix(docs, keep_columns=True)
    assert out.columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "taken"]
    assert out.count() == 5
    assert mixing.mix(empty(spark)).count() == 0
    blank = mixing.mix(frame(spark, [[1, None, None], [2, "", "a"]])).collect()
    assert [(r.taken, r.target) for r in blank] == [(0, 0.0), (0, 0.0)]


def plain_hits(rows, items):
    """(id, words, words hit, items) of each row."""
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    patterns = {}
    for i, t in items:
        w = rx.findall(lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n and i is not None else ():
            patterns.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    sizes = {len(p) for p in patterns}
    want = []
    for i, t, _ in rows:
        w = rx.findall(lower(t))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if names := patterns.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= names
        want.append((i, len(w), len(hit), sorted(found)))
    return want


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, block_bytes):
    rows = documents()
    items = [(1, " ".join(rows[0][1].split()[3:20])), (2, rows[2][1].upper()), (3, "one"), (4, ""), (5, None),
             (6, "  ...!"), (None, "la"), (7, "words in"), (10, "words, IN"), (8, "not to be found anywhere")]
    want = plain_hits(rows, items)
    table = spark.createDataFrame(items, "item_id long, text string")
    found = wumanber.find_items(frame(spark, rows), table, block_bytes=block_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(x[2] > 0 for x in want) > 3


def test_decontamination_of_nothing(spark):
    table = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in wumanber.find_items(frame(spark, documents()), table).collect()} == {0}
    some = spark.createDataFrame([(1, "la")], "item_id long, text string")
    assert wumanber.find_items(empty(spark), some).count() == 0


def test_cells_are_walked_in_order():
    rng = np.random.default_rng(1)
    index = ann.Index(rng.standard_normal((200, 8)), 8)
    index.sizes[:] = 1
    one, two = (d[0] for d in index.distances(rng.standard_normal((1, 8))))
    cells = list(index.walk(one, two, 64))
    sums = [one[i] + two[j] for i, j in cells]
    assert len(set(cells)) == 64 and sums == sorted(sums)


@pytest.mark.parametrize("query_block", [ann.QUERY_BLOCK, 9])
def test_neighbours(spark, query_block):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((5, 16))
    vec = {i: (centers[i % 5] + 0.3 * rng.standard_normal(16)).astype(np.float32).tolist() for i in range(3000)}
    for i in range(300, 700):
        vec[i] = vec[300]  # one vector very often
    rows = [(i, v, 1) for i, v in vec.items()]
    rows += [(5000, None, 1), (5100, [0.0] * 16, 1), (5200, [1.0] * 15 + [float("nan")], 1),
             (5300, [1.0] * 15 + [None], 1), (5400, [1.0] * 3, 1), (5500, [float("inf")] + [1.0] * 15, 1),
             (None, vec[1], 1), (5600, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, uid int")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 100 = 0"), query_block=query_block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.array(sorted(vec))
    m = np.array([vec[i] for i in ids], dtype=np.float64)
    asked = [i for i in ids if i % 100 == 0]
    assert sorted(got) == asked
    hits = 0
    for q in asked:
        dist = np.sqrt(((m - m[q]) ** 2).sum(axis=1))
        best = [int(j) for j in np.lexsort((ids, dist)) if j != q][:10]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(math.isclose(dist[i], s, abs_tol=1e-12) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(best))
        if 300 <= q < 700:
            assert [i for _, i, _ in found] == best  # ties by id
    assert hits / (10 * len(asked)) >= 0.95
    few = spark.createDataFrame([(100, [1.0, 2.0]), (7, [1.0, 2.5]), (200, [1.0, 2.0])],
                                "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ann.nearest(few, few.where("vec_id % 100 = 0")).collect())) == [
        (100, 1, 200, 0.0), (100, 2, 7, 0.5), (200, 1, 100, 0.0), (200, 2, 7, 0.5)]
    assert ann.nearest(few.limit(0), few.limit(0)).count() == 0


MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNTER = bpe.Counter(bpe.read_ranks(MODEL))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abe th  \n\t▁<s></s>0x.,ing\r"), st.characters(exclude_categories=["Cs"])),
               max_size=60))
def test_token_counts_equal_the_library(text):
    assert COUNTER(text) == len(LIBRARY.encode(text))


def test_token_counts(spark):
    rows = documents()
    got = bpe.token_counts(frame(spark, rows), MODEL, limit=100).collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "")), len(LIBRARY.encode(t or "")) > 100)
            for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.token_counts(empty(spark), MODEL).count() == 0
