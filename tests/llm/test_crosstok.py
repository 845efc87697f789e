"""Token alignment against a plain version over the libraries."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from corpus import documents, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import crosstok

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def coder():
    return crosstok.Coder(crosstok.Vocabularies(A, B))


def plain_groups(library, both, text):
    """[(A ids, B ids)] of the text, by walking over the ends."""
    if not text:
        return []
    a = library[0].encode(" " + text, add_special_tokens=False).ids
    b = library[1].encode(text)
    raw = (" " + text).encode()
    if b"".join(both.a[i] for i in a) != raw or b"".join(both.b[i] for i in b) != raw:
        return []
    out, one, two, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            one.append(a[i])
            at_a += len(both.a[a[i]])
            i += 1
        else:
            two.append(b[j])
            at_b += len(both.b[b[j]])
            j += 1
        if at_a == at_b:
            out.append((one, two))
            one, two = [], []
    return out


def plain(library, both, rows):
    groups = [plain_groups(library, both, t) for _, t, _ in rows]
    held = Counter(p for g in groups for p in {(x, y) for a, b in g for x in a for y in b})
    most = {}
    for (x, _), c in held.items():
        most[x] = max(most.get(x, 0), c)
    out = []
    for (i, _, _), g in zip(rows, groups, strict=True):
        links = [(x, y) for a, b in g for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


AWKWARD = ["<|endoftext|> and </s> <s> <unk>", "ﬁn Å Å ï", "▁mark", "a\x00b", "  two  spaces ", "\ttab\r\n\n", "漢字かな", "🙂🙃 ok",
           " ", "　", "don't we'll I'M", "1234567", "x" * 500, "é" * 300, "(((,,,;;;", "ẞß İi ſ", "áe‍"]


def test_same_ids_as_the_library(library, coder):
    for text in AWKWARD:
        assert coder.one.encode_ordinary(" " + text) == library[0].encode(" " + text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, coder, text):
    assert coder.one.encode_ordinary(" " + text) == library[0].encode(" " + text, add_special_tokens=False).ids
    a, b = coder.encode([text])[0]
    groups = plain_groups(library, coder.both, text)
    assert [x for g, _ in groups for x in g] == a and [y for _, g in groups for y in g] == b


@pytest.mark.parametrize("known", [crosstok.KNOWN, 5])
def test_equals_plain_version(spark, library, coder, monkeypatch, known):
    monkeypatch.setattr(crosstok, "KNOWN", known)
    rows = documents() + [[500 + i, t, "s"] for i, t in enumerate(AWKWARD)] + [[600, AWKWARD[0], "s"]] * 2
    got = crosstok.cross_align(frame(spark, rows), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain(library, coder.both, rows), key=str)
    assert crosstok.cross_align(empty(spark), A, B).collect() == []


def test_large_groups_in_slices():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 9, 200), rng.integers(0, 7, 150)
    first_a, m = np.array([0, 3, 103]), np.array([3, 100, 97])
    first_b, n = np.array([0, 2, 60]), np.array([2, 58, 90])
    want = Counter((g, int(x) * 10 + int(y)) for g in range(3) for x in a[first_a[g]:first_a[g] + m[g]]
                   for y in b[first_b[g]:first_b[g] + n[g]])
    for limit in (20, 10 ** 6):
        got = Counter()
        for d, k, t in crosstok.irregular_pairs(a, b, first_a, m, first_b, n, np.arange(3), 10, limit):
            assert limit < 100 or len(k) <= limit
            for x, y, z in zip(d.tolist(), k.tolist(), t.tolist(), strict=True):
                got[x, y] += z
        assert got == want


def test_text_over_a_chunk(spark, library, coder):
    rows = [[1, "some words, again and again. " * 40_000, "s"], [2, "some words", "s"]]
    got = sorted(tuple(r) for r in crosstok.cross_align(frame(spark, rows), A, B).collect())
    assert got == plain(library, coder.both, rows)
