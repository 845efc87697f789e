"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``WINDOW`` consecutive words of a benchmark item,
or the whole item if it has fewer.  Patterns of one length are searched
together: the shift table, indexed by a hashed block of two words, tells how
far the window can move on without missing an occurrence; where the shift is
0, the block selects the bucket of patterns that end with it; the first block
is compared next, and the words themselves decide.

A task searches many documents at once: every document (a long one in
stretches of ``LANE`` window ends) is a lane with its own position, and one
array step moves all lanes by their shifts.  Only the words at visited
positions are hashed.

The benchmark is dealt into blocks of patterns of about ``BLOCK_BYTES`` of
text by the hash of the pattern, so what is broadcast is bounded however
large the benchmark is; the documents pass all blocks in one job without a
shuffle, carrying the numbers of the patterns found so far.  The items of a
pattern, which may be very many, are joined to the numbers afterwards.

Null or empty texts have no words; an item without words or without an id
takes no part; items of equal text are all named.  Rows map one to one, so
null and repeated document ids, ties and extra columns change nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import arrays as A
from tallyspark.llm.frames import arrow_map, keep

WINDOW = 10
LANE = 256
BLOCK_BYTES = 8 << 20
_TABLE_BITS = 16


class Words:
    """The words of some documents, hashed where they are asked for."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data = A.LOWER[data]
        self.starts, self.ends, self.first = A.word_spans(self.data, offs, A.ALNUM)
        up, self.down = A.powers(len(data))
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(A.BYTE_VALUES[self.data] * up[:len(data)], out=self.total[1:])

    def hashes(self, index: np.ndarray) -> np.ndarray:
        s, e = self.starts[index], self.ends[index]
        return A.mix((self.total[e] - self.total[s]) * self.down[s] + (e - s).astype(np.uint64))

    def blocks(self, last: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words that end with each given word."""
        out = self.hashes(last - (size - 1))
        for back in range(size - 2, -1, -1):
            out = A.mix(out * A.U64(A.GRAM_BASE) + self.hashes(last - back))
        return out

    def text(self, begin: int, n: int) -> bytes:
        return b" ".join(self.data[self.starts[i]:self.ends[i]].tobytes() for i in range(begin, begin + n))


class Searcher:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, length: int, patterns: list[bytes]):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        joined = b"".join(patterns)
        ends = np.cumsum([len(p) for p in patterns])
        w = Words(np.frombuffer(joined, np.uint8), np.concatenate([[0], ends]).astype(np.int64))
        first = w.first[:-1]
        self.shift = np.full(1 << _TABLE_BITS, length - self.block + 1, dtype=np.int64)
        for at in range(self.block - 1, length):
            slot = self._slot(w.blocks(first + at, self.block))
            np.minimum.at(self.shift, slot, length - 1 - at)
        suffix = w.blocks(first + length - 1, self.block)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.prefix = w.blocks(first + self.block - 1, self.block)

    @staticmethod
    def _slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> A.U64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, w: Words) -> Iterator[tuple[int, int]]:
        """(first word, pattern number) of every occurrence."""
        counts = np.diff(w.first)
        ends = np.maximum(counts - self.length + 1, 0)  # window ends of each document
        lanes = -(-ends // LANE)
        doc = np.repeat(np.arange(len(counts)), lanes)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = w.first[:-1][doc] + self.length - 1
        at = begin + number * LANE
        stop = np.minimum(at + LANE, begin + ends[doc])
        found, found_block = [], []
        while len(at):
            block = w.blocks(at, self.block)
            move = self.shift[self._slot(block)]
            stay = move == 0
            if stay.any():
                found.append(at[stay])
                found_block.append(block[stay])
            at = at + np.where(stay, 1, move)
            on = at < stop
            at, stop = at[on], stop[on]
        if not found:
            return
        last, block = np.concatenate(found), np.concatenate(found_block)
        lo, hi = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        last, lo, n = last[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        if not len(last):
            return
        start = last - (self.length - 1)
        prefix = w.blocks(start + self.block - 1, self.block)
        each = np.repeat(np.arange(len(start)), n)
        pattern = self.order[np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + lo[each]]
        same = self.prefix[pattern] == prefix[each]
        for i, p in zip(start[each[same]].tolist(), pattern[same].tolist(), strict=True):
            if w.text(i, self.length) == self.patterns[p]:
                yield i, p


def _item_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                w = Words(data, offs)
                ids, sizes, wins = [], [], []
                for k, item in enumerate(rows.column("doc_id").to_pylist()):
                    lo, hi = int(w.first[k]), int(w.first[k + 1])
                    n = min(width, hi - lo)
                    for i in range(lo, hi - n + 1) if n else ():
                        ids.append(item)
                        sizes.append(n)
                        wins.append(w.text(i, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(sizes, pa.int32()), pa.array(wins, pa.binary())],
                    names=["item_id", "n", "pattern"])
    return run


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id string, n, pattern) of the distinct windows of each item."""
    rows = (items.select(F.col("item_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where("doc_id is not null"))
    return arrow_map(rows, _item_windows(width), "item_id string, n int, pattern binary").distinct()


_CARRY = "spans array<long>, patterns array<long>"
_FOUND = "n_words long, n_hit long, spans array<long>, patterns array<long>"


def _pass(shared, final: bool, with_text: bool):
    """One block of patterns over the documents; ``spans`` holds first word
    and length in turn.  Other columns pass through unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, dict[bytes, int]] = defaultdict(dict)
        for n, pattern, number in shared.value:
            by_length[n][pattern] = number
        searchers = [(Searcher(n, list(found)), list(found.values())) for n, found in sorted(by_length.items())]
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                w = Words(data, offs)
                spans = rows.column("spans").to_pylist()
                seen = [set(x) for x in rows.column("patterns").to_pylist()]
                for searcher, numbers in searchers:
                    for at, p in searcher.find(w):
                        k = int(np.searchsorted(w.first, at, "right")) - 1
                        spans[k] += [at - int(w.first[k]), searcher.length]
                        seen[k].add(numbers[p])
                out = {c: rows.column(c) for c in rows.schema.names if c not in ("spans", "patterns")}
                if final:
                    n_words = np.diff(w.first)
                    out["n_words"] = pa.array(n_words)
                    out["n_hit"] = pa.array([_covered(s, n) for s, n in zip(spans, n_words, strict=True)], pa.int64())
                if not with_text:
                    del out["text"]
                out["spans"] = pa.array(spans, pa.list_(pa.int64()))
                out["patterns"] = pa.array([sorted(x) for x in seen], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
    return run


def _covered(spans: list[int], n: int) -> int:
    """Words inside any span."""
    if not spans:
        return 0
    step = np.zeros(n + 1, dtype=np.int64)
    s = np.array(spans).reshape(-1, 2)
    np.add.at(step, s[:, 0], 1)
    np.add.at(step, s[:, 0] + s[:, 1], -1)
    return int((np.cumsum(step) > 0).sum())


def find_windows(docs: DataFrame, patterns: DataFrame, block_bytes: int = BLOCK_BYTES,
                 carried: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, patterns) for every row of ``docs``:
    words, words inside an occurrence, the occurrences as first word and
    length in turn, and the numbers of the patterns (n, pattern, number) found.

    ``carried`` names a column of ``docs`` that the result keeps beside the
    text; the others stay out.
    """
    spark = docs.sparkSession
    total = patterns.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    mine = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
    extra = [F.col(f"`{carried}`").alias("carried")] if carried else []
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        *extra, F.array().cast("array<long>").alias("spans"),
                        F.array().cast("array<long>").alias("patterns"))
    for b in range(blocks):
        part = [(r.n, bytes(r.pattern), r.number) for r in patterns.where(mine == b).collect()]
        final = b == blocks - 1
        own = [f for f in found.schema.fields if f.name not in ("spans", "patterns")
               and not (final and not carried and f.name == "text")]
        schema = T.StructType(own + T._parse_datatype_string(_FOUND if final else _CARRY).fields)
        found = arrow_map(found, _pass(spark.sparkContext.broadcast(part), final, not final or bool(carried)), schema)
    return found.withColumnRenamed("carried", carried) if carried else found


def numbered_patterns(windows: DataFrame) -> DataFrame:
    """(n, pattern, number) of the distinct patterns."""
    return keep(windows.select("n", "pattern").distinct().withColumn("number", F.monotonically_increasing_id()),
                "patterns")


def find_items(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) for every row of ``docs``, as
    ``find_windows``, with the sorted ids of the items that occur."""
    windows = keep(item_windows(items, width), "item_windows")
    patterns = numbered_patterns(windows)
    found = keep(find_windows(docs, patterns, block_bytes).withColumn("row", F.monotonically_increasing_id()), "found")
    names = (found.select("row", F.explode("patterns").alias("number")).join(patterns, "number")
             .join(windows, ["n", "pattern"]).groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return (found.join(names, "row", "left")
            .select("doc_id", "n_words", "n_hit", "spans",
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean_documents(docs: DataFrame, items: DataFrame, carried: str, width: int = WINDOW) -> DataFrame:
    """(doc_id, text, ``carried``) of the documents without a word in an
    occurrence of an item's window; the items are not asked for."""
    found = find_windows(docs, numbered_patterns(item_windows(items, width)), carried=carried)
    return found.where("n_hit = 0").select("doc_id", "text", carried)


_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The same in DuckDB, for unique document ids: windows of every length joined with the patterns.
ORACLE = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_RE}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOW}, '{_RE}') AS w
          FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT *, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS p
             FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM patterns),
windows AS (SELECT doc_id, n, i, w[i:i + n - 1] AS p
            FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i
                  FROM docs JOIN sizes ON len(w) >= n)),
hits AS (SELECT doc_id, i, windows.n, item_id FROM windows JOIN patterns USING (n, p)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
"""
