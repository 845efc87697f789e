"""Runs of periodic words by suffix trees and Lyndon roots.

A run is a stretch of words with smallest period q, of ``LEAST`` words and
``TIMES`` periods at least, that no neighbouring word extends.  Every run has
a root: the longest Lyndon word that begins at one of its positions, in an
order of the words or in the reversed one.  So one candidate per position and
order is enough: the next smaller suffix bounds the Lyndon word, whose length
is the period, and the candidate is extended to the right and to the left by
longest common extensions.

Extensions come from two suffix trees, of the words and of their reversal,
built by Ukkonen's algorithm.  A depth-first tour notes, between each two
leaves, the depth of the shallowest node passed, that of their lowest common
ancestor; a sparse table over these depths then answers a query with two
looks.  The same tour, with the children in one order and in the other, ranks
the suffixes for the Lyndon words.

Trees are built for the stretches that can hold a run: in a run each three
adjoining words occur ``TIMES - 1`` times or more, so stretches without such
threes can't.  The cut loses no run, and none of its words (see ``stretches``).  Many
stretches, with a word of its own after each, share a tree.

Words are told apart by 64-bit hashes.  A null text has no words, an empty
one neither: no runs, nulls for the run, digests of the empty string.  A null
id has no checksum, so its words stay as they are.  Rows map one to one:
ties, repeated rows and extra columns change nothing.  A task holds one chunk
of about a megabyte or one longer text, with some 400 bytes for each word of
the stretches at hand and 100 for each of the others.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.frames import arrow_map, texts

LEAST, TIMES = 6, 4
#: Words in a tree (a longer stretch has a tree of its own).
TREE = 1 << 16
RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class SuffixTree:
    """Ukkonen's tree of a sequence whose last symbol occurs once."""

    def __init__(self, s: list[int], symbols: int):
        n = len(s)
        go: dict[int, int] = {}
        find = go.get
        start, end, link = array("i", [0]), array("i", [0]), array("i", [0])
        note = array("i", [0])  # of a leaf its suffix, of another node its depth in symbols
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                key = node * symbols + s[edge]
                child = find(key)
                if child is None:
                    go[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    note.append(i - waiting + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    begin = start[child]
                    span = end[child] - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[begin + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    mid = len(start)
                    go[key] = mid
                    go[mid * symbols + c] = mid + 1
                    go[mid * symbols + s[begin + length]] = child
                    start.extend((begin, i))
                    end.extend((begin + length, n))
                    link.extend((0, 0))
                    note.extend((waiting - 1, i - waiting + 1))
                    start[child] = begin + length
                    if last:
                        link[last] = mid
                    last = mid
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.keys = np.fromiter(go.keys(), np.int64, len(go))
        self.child = np.fromiter(go.values(), np.int64, len(go))
        self.note = np.frombuffer(note, dtype=np.int32)
        self.leaf = np.frombuffer(end, dtype=np.int32) == n
        self.symbols, self.n = symbols, n

    def tour(self, order: np.ndarray | None = None):
        """(suffixes as the tour meets them, depth of the lowest common
        ancestor of each two neighbours).  ``order`` ranks the symbols."""
        parent, symbol = np.divmod(self.keys, self.symbols)
        rank = symbol if order is None else order[symbol]
        place = np.argsort(-(parent * self.symbols + rank))  # a stack gives the last one first
        kids, of = self.child[place], -parent[place]
        every = -np.arange(len(self.note))
        low = np.searchsorted(of, every).tolist()
        high = np.searchsorted(of, every, side="right").tolist()
        up = np.zeros(len(self.note), np.int64)
        up[self.child] = parent
        kids, seen, stack = kids.tolist(), [], [0]
        pop, add, more = stack.pop, seen.append, stack.extend
        while stack:
            v = pop()
            add(v)
            more(kids[low[v]:high[v]])
        seen = np.array(seen)
        at = np.flatnonzero(self.leaf[seen])
        return self.note[seen[at]], self.note[up[seen[at[:-1] + 1]]]


class Extensions:
    """Longest common extensions of the suffixes of a tree."""

    def __init__(self, suffixes: np.ndarray, depths: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.least = [depths]
        while (step := 1 << len(self.least)) <= len(depths):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-(step // 2)], last[step // 2:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            least = self.least[k]
            out[at] = np.minimum(least[a[at]], least[b[at] - (1 << int(k))])
        return out


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """Of each place the next one with a smaller rank (the length if none)."""
    values = rank.tolist()
    out, stack = [len(values)] * len(values), []
    for i, r in enumerate(values):
        while stack and values[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, dtype=np.int64)


def runs_of(words: np.ndarray, cuts: np.ndarray, least: int = LEAST, times: int = TIMES):
    """(begin, end, period) of the runs in ``words``; none crosses a cut.

    ``cuts`` are the bounds of the stretches, from 0 to the number of words."""
    letters, coded = np.unique(words, return_inverse=True)
    pieces = len(cuts) - 1
    # A separator of its own before all and after each stretch, smaller than any letter in both orders.
    s = np.empty(len(words) + pieces + 1, np.int64)
    stretch = np.repeat(np.arange(pieces), np.diff(cuts))
    where = np.arange(len(words)) + stretch + 1
    s[cuts + np.arange(pieces + 1)] = np.arange(pieces + 1)
    s[where] = coded + pieces + 1
    n, symbols = len(s), pieces + 1 + len(letters)
    reverse = Extensions(*SuffixTree(s[::-1].tolist(), symbols).tour())
    tree = SuffixTree(s.tolist(), symbols)
    turned = np.concatenate([np.arange(pieces + 1), np.arange(symbols - 1, pieces, -1)])
    found = []
    forward = Extensions(*tree.tour())
    other = np.empty(n, np.int64)
    other[tree.tour(turned)[0]] = np.arange(n)
    for rank in (forward.rank, other):
        after = _next_smaller(rank)[where]
        period = after - where
        right = forward(where, after)
        left = reverse(n - where, n - after)
        begin, end = where - left, after + right
        full = np.flatnonzero(end - begin >= np.maximum(least, times * period))
        found.append(np.stack([begin[full], end[full], period[full]]))
    begin, end, period = np.unique(np.concatenate(found, axis=1), axis=1)
    shift = stretch[np.searchsorted(where, begin)] + 1
    return begin - shift, end - shift, period


def stretches(words: np.ndarray, part: np.ndarray, times: int = TIMES):
    """(begin, end) of the stretches that can hold runs.

    In a run of ``times`` >= 4 periods q each three adjoining words occur
    ``times - 1`` times or more: they begin at every place but the last two, and those are
    2 of times * q (a period of 1 has 6 words at least, so 4 places).  A stretch is a longest row of places
    whose three words occur as often inside their part (at first the
    document); this is repeated until nothing shrinks.  A run lies whole in
    one stretch, and a run of the stretch ends where it does in the document:
    were it longer there, the longer one would lie in the stretch too."""
    at = np.flatnonzero((part[:-2] == part[2:])) if len(words) > 2 else np.zeros(0, np.int64)
    three = A.mix(words[at] * A.U64(A.BASE) + A.mix(words[at + 1] * A.U64(A.GRAM_BASE) + A.mix(words[at + 2]))) \
        if len(at) else np.zeros(0, np.uint64)
    group = part[at]
    while len(at):
        _, back, count = np.unique(three ^ A.mix(group.astype(np.uint64)), return_inverse=True, return_counts=True)
        often = count[back] >= times - 1
        stay = np.flatnonzero(often)
        all_stay = len(stay) == len(at)
        at, three, old = at[stay], three[stay], group[stay]
        if not len(at):
            break
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (old[1:] != old[:-1])
        group = np.cumsum(new)
        # Rows of fewer than LEAST - 2 places are too short.
        size = np.bincount(group)
        long = size[group] >= LEAST - 2
        if all_stay and long.all() and np.array_equal(new[1:], old[1:] != old[:-1]):
            break
        at, three, group = at[long], three[long], group[long]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.append(True, group[1:] != group[:-1])
    return at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + 3


def find_runs(words: np.ndarray, part: np.ndarray):
    """(begin, end, period) of all runs, by begin and period.  ``part`` is the
    document of each word."""
    begin, end = stretches(words, part)
    size = end - begin
    out, at = [np.zeros((3, 0), np.int64)], 0
    while at < len(begin):
        to = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), TREE, side="right")))
        cuts = np.concatenate([[0], np.cumsum(size[at:to])])
        place = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - begin[at:to], size[at:to])
        b, e, p = runs_of(words[place], cuts)
        out.append(np.stack([place[b], place[e - 1] + 1, p]))
        at = to
    begin, end, period = np.concatenate(out, axis=1)
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words, taken in pieces of bounded size."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + A.CHUNK, side="right")))
        low = int(starts[at])
        out[at:to] = A.span_hashes(data[low:int(ends[to - 1])], starts[at:to] - low, ends[at:to] - low)
        at = to
    return out


def _rewritten(first: np.ndarray, check: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which word stands at each place after the contract's rewriting."""
    n = np.diff(first)
    place = np.arange(first[-1])
    for d in np.flatnonzero(known & (check % 10 == 0) & (n > 0)):
        g, size = int(check[d]) // 10, int(n[d])
        a = g % size
        p = 1 + (size - a) // (3 + g % 8)
        place[first[d] + a:first[d + 1]] = first[d] + a + np.arange(size - a) % p
    return place


def _digest(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()


def _periods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = _digest(b"")
    for batch in batches:
        for rows, data, offs in A.chunks(batch):
            starts, ends, first = A.word_spans(data, offs, A.SPACED)
            check = rows.column("h")
            known = check.is_valid().to_numpy(zero_copy_only=False)
            place = _rewritten(first, check.fill_null(0).to_numpy(), known)
            words = _hashes(data, starts, ends)[place]
            docs = len(offs) - 1
            begin, end, period = find_runs(words, np.repeat(np.arange(docs), np.diff(first)))
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, begin + period, 1)
            np.add.at(gone, end, -1)
            stays = np.cumsum(gone)[:-1] == 0
            bounds = np.searchsorted(begin, first)
            length = end - begin
            count = np.diff(bounds)
            best = np.full((4, docs), -1)
            runs, collapsed = [nothing] * docs, [nothing] * docs
            for d in range(docs):
                a, b = first[d], first[d + 1]
                if a == b:
                    continue
                text = data[offs[d]:offs[d + 1]].tobytes().split()
                if count[d]:
                    mine = slice(bounds[d], bounds[d + 1])
                    start, size, own = begin[mine] - a, length[mine], period[mine]
                    # Different quotients of integers this small are different doubles.
                    top = np.lexsort((own, start, -(size / own)))[0]
                    best[:, d] = start[top], size[top], own[top], 1000 * size[top] // own[top]
                    runs[d] = _digest(b"".join(b"%d,%d,%d\n" % x for x in zip(
                        start.tolist(), size.tolist(), own.tolist(), strict=True)))
                if count[d] or place[b - 1] != b - 1:
                    text = [text[i] for i in (place[a:b][stays[a:b]] - a).tolist()]
                collapsed[d] = _digest(b" ".join(text))
            none = count == 0
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(count), *(pa.array(x, mask=none) for x in best),
                 pa.array(runs, pa.string()), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                       "collapsed_sha256"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: number of runs, the run with the most
    periods, digests of all runs and of the words left."""
    rows = texts(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return arrow_map(rows, _periods, RESULT)
