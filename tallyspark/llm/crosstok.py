"""Aligning the tokens of two tokenizers by the bytes they cover.

A is a byte-level BPE vocabulary, B a sentencepiece model that puts a space
first; a text is encoded as space + text by A and as itself by B, so the
tokens of both cover the same bytes.  Where tokens of both end, the sequences are cut
into groups; all A and B tokens of a group are linked.

Most groups hold one token of each.  Then both have the same bytes, and an
array over A's vocabulary, computed once, says which B id has the bytes of an
A id: such a pair is known by its A id alone.  In how many documents it is
linked is counted in a vector over A's vocabulary, one for each task; only the
other pairs, out of irregular groups, enter the shuffle that counts pairs.

The rows of the first pass (per document the distinct pairs and how often
each occurs) are written once; the second pass looks the counts up.  The
vectors over A's vocabulary and the ``KNOWN`` most frequent other pairs are
broadcast (fixed bounds); rarer pairs come by a join, which no frequent pair
enters.

Texts that are null or empty, or that one of the tokenizers doesn't give back
byte for byte, have no tokens: zeros, and '' for the groups.  Special tokens'
strings are plain text.  Rows map one to one, so null or repeated ids, ties
and extra columns change nothing; a repeated document counts each time.  A
task holds one chunk of about a megabyte or one longer text (about 100 bytes for each
token); a group of very many tokens is linked in slices of ``SLICE`` pairs,
by distinct ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.frames import arrow_map, keep, texts
from tallyspark.llm.hmm import frequent_tokens

KNOWN = 1 << 18
CHUNK = 1 << 20
SLICE = 1 << 21
#: Fixed values of byte-level vocabularies: the pattern of the stretches that
#: merge on their own, and the bytes that stand for themselves (the others
#: are written as the characters from U+0100 on, in order).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

_coders: dict[int, Coder] = {}


def byte_vocabulary(json_file: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    with open(json_file, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = {chr(b): b for b in PLAIN}
    rest = (b for b in range(256) if b not in byte.values())
    byte |= {chr(0x100 + k): b for k, b in enumerate(list(rest))}
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(byte[c] for c in token)
    return out


def piece_vocabulary(model: bytes) -> list[bytes]:
    """The bytes of each id of a sentencepiece model (none of control ids)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append(bytes([int(piece[3:-1], 16)]))
        else:
            out.append(b"" if sp.is_control(i) or sp.is_unknown(i) else piece.replace("▁", " ").encode())
    return out


class Vocabularies:
    """Both vocabularies and the identity map; what is broadcast."""

    def __init__(self, json_file: str, model_file: str):
        self.a = byte_vocabulary(json_file)
        with open(model_file, "rb") as f:
            self.model = f.read()
        self.b = piece_vocabulary(self.model)
        by_bytes = {x: i for i, x in reversed(list(enumerate(self.b))) if x}
        #: The B id of the same bytes (the smallest of several), or -1.
        self.same = np.array([by_bytes.get(x, -1) for x in self.a])
        self.size_a = np.array([len(x) for x in self.a])
        self.size_b = np.array([len(x) for x in self.b])

    @property
    def wide(self) -> int:
        return len(self.b)


class Coder:
    """The tokenizers themselves, once per Python worker."""

    def __init__(self, both: Vocabularies):
        import sentencepiece
        import tiktoken

        ranks = {x: i for i, x in enumerate(both.a) if x}
        self.one = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.two = sentencepiece.SentencePieceProcessor(model_proto=both.model)
        self.both = both
        # What each id looks like in a group's text, with the sign behind it.
        n, m = len(both.a), len(both.b)
        self.signs = [b"%d%s" % (i, s) for k, pair in ((n, b",|"), (m, b",;"))
                      for s in (pair[:1], pair[1:]) for i in range(k)]

    def encode(self, some: list[str]):
        """(A ids, B ids) of each text, both empty if one of them doesn't give the text back."""
        out = []
        for text, b in zip(some, self.two.encode(some, num_threads=1), strict=True):
            a = self.one.encode_ordinary(" " + text)
            raw = b" " + text.encode()
            if not text or not a or not b or b"".join(itemgetter(*a, a[0])(self.both.a)[:-1]) != raw \
                    or b"".join(itemgetter(*b, b[0])(self.both.b)[:-1]) != raw:
                a = b = []
            out.append((a, b))
        return out


def _summed(key: np.ndarray, times: np.ndarray):
    """Distinct keys and the sums of their times."""
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[new], np.add.reduceat(times, new) if len(new) else times


def irregular_pairs(a, b, first_a, m, first_b, n, doc, wide: int, limit: int = SLICE):
    """(document, pair, times) lists of the links of groups of ``m`` and ``n``
    tokens that begin at ``first_a`` and ``first_b``."""
    links = m * n
    at = 0
    while at < len(m):
        to = max(at + 1, int(np.searchsorted(np.cumsum(links[at:]), limit, side="right")) + at)
        if to == at + 1 and links[at] > limit:  # one large group: by distinct ids
            one, times_one = np.unique(a[first_a[at]:first_a[at] + m[at]], return_counts=True)
            two, times_two = np.unique(b[first_b[at]:first_b[at] + n[at]], return_counts=True)
            step = max(1, limit // len(two))
            for k in range(0, len(one), step):
                key = (one[k:k + step, None] * wide + two[None]).ravel()
                yield np.full(len(key), doc[at]), key, (times_one[k:k + step, None] * times_two[None]).ravel()
        else:
            part = slice(at, to)
            size = links[part]
            group = np.repeat(np.arange(at, to), size)
            inside = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
            key = a[first_a[group] + inside // n[group]] * wide + b[first_b[group] + inside % n[group]]
            yield doc[group], key, np.ones(len(key), np.int64)
        at = to


def align(coder: Coder, some: list[tuple[list[int], list[int]]]):
    """Per document (columns of the first pass but the id)."""
    both = coder.both
    docs, wide = len(some), both.wide
    n_a, n_b = (np.array([len(x[k]) for x in some], dtype=np.int64) for k in (0, 1))
    a = np.fromiter((i for x in some for i in x[0]), np.int64, n_a.sum())
    b = np.fromiter((i for x in some for i in x[1]), np.int64, n_b.sum())
    end_a, end_b = np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b])
    mark = np.zeros((end_a[-1] if len(a) else 0) + 1, bool)
    mark[end_b] = True
    cut_a = mark[end_a]
    mark[:] = False
    mark[end_a] = True
    cut_b = mark[end_b]
    last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    first_a, first_b = (np.append(0, x[:-1] + 1) if len(x) else x for x in (last_a, last_b))
    m, n = last_a - first_a + 1, last_b - first_b + 1
    doc_a = np.repeat(np.arange(docs), n_a)
    doc = doc_a[last_a]
    n_groups = np.bincount(doc, minlength=docs)
    n_links = np.zeros(docs, np.int64)
    np.add.at(n_links, doc, m * n)

    # The groups as text: A's ids of a group stand before B's.
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    shown = np.empty(len(a) + len(b), np.int64)
    va, vb = len(both.a), len(both.b)
    shown[np.arange(len(a)) + first_b[group_a]] = a + va * cut_a
    shown[np.arange(len(b)) + last_a[group_b] + 1] = 2 * va + b + vb * cut_b
    signs, shown = coder.signs, shown.tolist()
    digests, at = [], 0
    for k in (n_a + n_b).tolist():
        digests.append(hashlib.sha256(b"".join(map(signs.__getitem__, shown[at:at + k]))[:-1]).hexdigest()
                       if k else "")
        at += k

    # Links: distinct pairs of each document, the identity pairs apart.
    plain = (m == 1) & (n == 1)
    odd = np.flatnonzero(~plain)
    found = [(doc[plain], a[first_a[plain]] * wide + b[first_b[plain]], np.ones(plain.sum(), np.int64))]
    found += irregular_pairs(a, b, first_a[odd], m[odd], first_b[odd], n[odd], doc[odd], wide)
    whole, times = _summed(np.concatenate([d * (va * wide) + k for d, k, _ in found]),
                           np.concatenate([t for *_, t in found]))
    of, pair = np.divmod(whole, va * wide)
    own = both.same[pair // wide] == pair % wide

    def lists(at: np.ndarray, values: np.ndarray, kind):
        cuts = np.append(0, np.cumsum(np.bincount(of[at], minlength=docs))).astype(np.int32)
        return (pa.ListArray.from_arrays(pa.array(cuts), pa.array(values[at], kind)),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(times[at], pa.int32())))

    return [pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links), pa.array(digests, pa.string()),
            *lists(np.flatnonzero(own), pair // wide, pa.int32()), *lists(np.flatnonzero(~own), pair, pa.int64())]


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "own", "own_times", "other", "other_times"]
_FIRST = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, own array<int>, "
          "own_times array<int>, other array<long>, other_times array<int>")


def _encoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.id not in _coders:
            _coders.clear()
            _coders[shared.id] = Coder(shared.both.value)
        coder = _coders[shared.id]
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some, size = [], 0
                for x in batch.column("text")[at:]:
                    text = x.as_py() or ""
                    if some and size + len(text) > CHUNK:
                        break
                    some.append(text)
                    size += len(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(some)), *align(coder, coder.encode(some))], names=NAMES)
                at += len(some)
    return run


class _Shared:
    """A broadcast with a key for what workers build from it."""

    def __init__(self, sc, both: Vocabularies):
        self.both = sc.broadcast(both)
        self.id = id(self.both) ^ hash(sc.applicationId)


def _vectors(ids: int):
    """How many documents hold each identity pair: one vector a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ids, np.int64)
        for batch in batches:
            own = batch.column("own").flatten().to_numpy()
            total += np.bincount(own, minlength=ids)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["a", "c"])
    return run


_SECOND = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, best long, "
           "total long, far array<long>, far_times array<int>")


def _looked_up(shared):
    """Sums over the pairs whose counts are at hand; the others go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_count, most, wide, known, known_count = shared.value
        for batch in batches:
            docs = batch.num_rows
            sums = np.zeros((2, docs), np.int64)

            def flat(name, docs=docs, batch=batch):
                col = batch.column(name)
                size = np.diff(col.offsets.to_numpy())
                return np.repeat(np.arange(docs), size), col.flatten().to_numpy()

            def add(doc, count, a, times, sums=sums, most=most):
                np.add.at(sums[0], doc, times * (count == most[a]))
                np.add.at(sums[1], doc, times * count)

            doc, a = flat("own")
            add(doc, own_count[a], a, flat("own_times")[1])
            doc, pair = flat("other")
            times = flat("other_times")[1]
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            add(doc[hit], known_count[at[hit]], pair[hit] // wide, times[hit])
            cuts = np.append(0, np.cumsum(np.bincount(doc[~hit], minlength=docs))).astype(np.int32)
            far = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[~hit])) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in NAMES[:6]), pa.array(sums[0]), pa.array(sums[1]), *far],
                names=[*NAMES[:6], "best", "total", "far", "far_times"])
    return run


def cross_align(docs: DataFrame, json_file: str, model_file: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    for every row of ``docs``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    both = Vocabularies(json_file, model_file)
    ids, wide = len(both.a), both.wide
    first = keep(arrow_map(texts(docs), _encoded(_Shared(sc, both)), _FIRST), "aligned")
    own = (arrow_map(first.select("own"), _vectors(ids), "a int, c long").groupBy("a").agg(F.sum("c").alias("c"))
           .toArrow())  # as many rows as A has ids at most
    others = keep(first.select(F.explode("other").alias("pair")).groupBy("pair").agg(F.count("*").alias("c")), "pairs")
    a = F.expr(f"pair div {wide}").cast("int")
    tops = others.groupBy(a.alias("a")).agg(F.max("c").alias("c")).toArrow()  # likewise
    own_count, most = np.zeros(ids, np.int64), np.zeros(ids, np.int64)
    own_count[own.column("a").to_numpy()] = own.column("c").to_numpy()
    most[tops.column("a").to_numpy()] = tops.column("c").to_numpy()
    most = np.maximum(most, own_count)
    known = frequent_tokens(others, KNOWN).toArrow().sort_by("pair")
    shared = sc.broadcast((own_count, most, wide, known.column("pair").to_numpy(), known.column("c").to_numpy()))
    looked = keep(arrow_map(first, _looked_up(shared), _SECOND)
                  .withColumn("row", F.monotonically_increasing_id()), "looked_up")
    far = (looked.select("row", F.explode(F.arrays_zip("far", "far_times")).alias("x"))
           .select("row", F.col("x.far").alias("pair"), F.col("x.far_times").alias("times")))
    limits = spark.createDataFrame(pa.table({"a": pa.array(np.arange(ids), pa.int32()), "most": pa.array(most)}))
    rare = (far.join(others, "pair").withColumn("a", a).join(F.broadcast(limits), "a").groupBy("row")
            .agg(F.sum(F.when(F.col("c") == F.col("most"), F.col("times")).otherwise(0)).alias("far_best"),
                 F.sum(F.col("c") * F.col("times")).alias("far_total")))
    more = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).cast("long")
    return (looked.join(rare, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", more("best", "far_best").alias("n_best"),
                    more("total", "far_total").alias("count_sum"), "groups_sha256"))
