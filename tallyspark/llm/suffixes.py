"""Removing repeated byte strings with a logarithmic family of sparse suffix
tables.

A byte goes if a string of ``width`` bytes that covers it also starts
somewhere else, in the same document or another.

Suffixes.  Sorting every suffix would move each byte many times, so the
tables hold a sparse set that misses no match: of the ``GRAM``-byte strings in
each window of ``width`` bytes, the one with the smallest hash is the window's
anchor (about one byte in seventy is one).  Equal windows have their anchor at
the same place, so a repeated string shows as suffixes at anchors with a
common prefix.  An entry is (anchor, context, times): the fingerprint
of the suffix's first ``GRAM`` bytes; the fingerprint of all windows of one
anchor place in a row, with the anchor's place in them; and how often it
occurs.  Entries are ordered by fingerprint, not by byte: no suffix order is
made and no common prefix measured.  Equal suffixes stand together, which is
all that matching needs; the strings at the edges of a match are compared as
windows.  In byte order an entry would carry its first 48 bytes instead of
eight.

Family.  Documents come in batches.  A batch's table is merge-scanned against
each level (a join of tables that are bucketed and sorted alike, so without a
shuffle); equal contexts are matches.  Then levels of equal size merge, as in
a binary counter, so an entry is rewritten a logarithmic number of times.

Windows.  Where a context occurs twice, all its windows do.  An anchor with
several contexts stands at the edge of a match: there the windows themselves
are compared, in tasks that hold whole anchors in order; an anchor with over
``CLASS`` contexts is dealt out by window instead.  Both ways are exact.

The second pass over the texts emits only entries that Bloom filters (a
broadcast of fixed size) do not rule out; a join with the
matches settles which are real, so a full filter would cost time, not truth.

Null texts are empty.  Rows of equal id and text repeat each other; rows
without an id are told apart by their text.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.bloom import bloom, maybe
from tallyspark.llm.frames import arrow_map, keep
from tallyspark.session import shared_path

GRAM = 48
CLASS = 1 << 15
#: Windows of a row that a task compares at a time: memory is CLASS rows times this.
STRIPE = 16
BATCHES = 4


def keyed(docs: DataFrame) -> DataFrame:
    """(id0, th, doc_id, text): the two keys together name a row's id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(own, F.lit(0)).alias("id0"), F.xxhash64(text, own.isNull()).alias("th"),
                       own.alias("doc_id"), text.alias("text"))


class Anchors:
    """The anchors of some documents: per run of windows with one anchor its
    place, the run's first and last window, and the two fingerprints."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, width: int):
        self.data, self.offs, self.width = data, offs, width
        n, span = len(data), width - GRAM + 1
        self.doc = self.at = self.begin = self.last = np.zeros(0, np.int64)
        self.anchor = self.context = np.zeros(0, np.uint64)
        if n < width:
            return
        up, down = A.powers(n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(A.BYTE_VALUES[data] * up[:n], out=total[1:])
        gram = A.mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
        # Hash above, place below: the minimum is the leftmost of the smallest.
        bits = A.U64(n.bit_length())
        mask = (A.U64(1) << bits) - A.U64(1)
        least = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
        step = 1
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < span:
            least = np.minimum(least[:len(least) - (span - step)], least[span - step:])
        place = (least & mask).astype(np.int64)
        whole = np.zeros(n - width + 1, dtype=bool)
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            if b - a >= width:
                whole[a:b - width + 1] = True
        window = np.flatnonzero(whole)
        if not len(window):
            return
        place = place[window]
        new = np.ones(len(window), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
        first = np.flatnonzero(new)
        self.at, self.begin = place[first], window[first]
        self.last = window[np.append(first[1:], len(window)) - 1]
        self.doc = np.searchsorted(offs, self.begin, side="right") - 1
        self.anchor = gram[self.at]
        extent = (self.at - self.begin) * width + (self.last - self.begin)
        whole_run = (total[self.last + width] - total[self.begin]) * down[self.begin]
        self.context = A.mix(A.mix(whole_run) + extent.astype(np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _array_entries(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offs in A.chunks(batch):
                a = Anchors(data, offs, width)
                yield pa.RecordBatch.from_arrays([_signed(a.anchor), _signed(a.context)], names=["anchor", "context"])
    return run


class SuffixFamily:
    """Suffix arrays of geometrically growing size, and the matches found.

    ``add`` takes a batch of documents; ``matches`` are the (anchor, context)
    that occur at least twice in all batches so far, ``entries`` all distinct
    ones.
    """

    def __init__(self, spark: SparkSession, width: int, buckets: int | None = None):
        self.spark, self.width = spark, width
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[DataFrame | None] = []
        self.found: list[DataFrame] = []
        self.places: dict[int, tuple[str, str]] = {}  # table and folder of each array

    def _stored(self, df: DataFrame) -> DataFrame:
        """An array, bucketed and sorted, in the shared folder.  ``df`` comes
        from a shuffle on the bucket columns (or a join of arrays), so each
        bucket is in one task and makes one file."""
        name, path = f"suffixes_{uuid.uuid4().hex}", shared_path(self.spark, "suffixes")
        (df.write.format("parquet").bucketBy(self.buckets, "context", "anchor").sortBy("context", "anchor")
         .option("path", path).saveAsTable(name))
        stored = self.spark.table(name)
        self.places[id(stored)] = (name, path)
        return stored

    def _superseded(self, table: DataFrame) -> None:
        """Remove an array whose entries are all in a merged one."""
        name, path = self.places.pop(id(table))
        self.spark.sql(f"DROP TABLE {name}")
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def add(self, rows: DataFrame) -> None:
        """``rows`` has a column text."""
        fresh = self._stored(
            arrow_map(rows.select("text"), _array_entries(self.width), "anchor long, context long")
            .groupBy("context", "anchor").agg(F.count("*").alias("times")))
        self.found.append(keep(fresh.where("times > 1").select("context", "anchor"), "matches"))
        for level in self.levels:
            if level is not None:
                met = fresh.select("context", "anchor").join(level.select("context", "anchor"), ["context", "anchor"])
                self.found.append(keep(met, "matches"))
        depth = 0
        while depth < len(self.levels) and self.levels[depth] is not None:
            older, newer = self.levels[depth], fresh
            fresh = self._stored(self._merged(newer, older))
            self._superseded(older)
            self._superseded(newer)
            self.levels[depth] = None
            depth += 1
        if depth == len(self.levels):
            self.levels.append(None)
        self.levels[depth] = fresh

    @staticmethod
    def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select("context", "anchor", F.col("times").alias("more"))
        return (a.join(b, ["context", "anchor"], "full_outer")
                .select("context", "anchor",
                        (F.coalesce("times", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("times")))

    def close(self) -> None:
        """Remove the arrays that are left."""
        for level in self.levels:
            if level is not None:
                self._superseded(level)
        self.levels = []

    def matches(self) -> DataFrame:
        out = self.found[0]
        for more in self.found[1:]:
            out = out.union(more)
        return out.distinct()

    def entries(self) -> DataFrame:
        arrays = [x.select("context", "anchor") for x in self.levels if x is not None]
        out = arrays[0]
        for more in arrays[1:]:
            out = out.union(more)
        return out


_PLACED = [("id0", pa.int64()), ("th", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64()),
           ("begin", pa.int64()), ("end", pa.int64()), ("left", pa.int32()), ("bytes", pa.binary())]
PLACED = "id0 long, th long, anchor long, context long, begin long, end long, left int, bytes binary"


def _placed(width: int, doubled, edges):
    """Entries of the texts that may be matched (``bytes`` null) or that may
    stand at the edge of a match (``bytes``: all their windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                a = Anchors(data, offs, width)
                twice = maybe(doubled.value, a.context)
                edge = np.flatnonzero(maybe(edges.value, a.anchor))
                # A matched context is needed once for comparison.
                _, once = np.unique(a.context[edge], return_index=True)
                edge = edge[np.sort(once)]
                id0 = rows.column("id0").to_numpy()
                th = rows.column("th").to_numpy()
                raw = data.tobytes()
                for index, spans in ((np.flatnonzero(twice), None),
                                     (edge, [raw[b:e] for b, e in zip(a.begin[edge].tolist(),
                                                                      (a.last[edge] + width).tolist(), strict=True)])):
                    doc = a.doc[index]
                    begin = a.begin[index] - offs[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(id0[doc]), pa.array(th[doc]), _signed(a.anchor[index]), _signed(a.context[index]),
                         pa.array(begin), pa.array(a.last[index] + width - offs[doc]),
                         pa.array((a.at[index] - a.begin[index]).astype(np.int32)),
                         pa.nulls(len(index), pa.binary()) if spans is None else pa.array(spans, pa.binary())],
                        schema=pa.schema(_PLACED))
    return run


class _Spans:
    """The bytes of some entries, and the windows in them."""

    def __init__(self, rows: pa.RecordBatch, width: int):
        raw = rows.column("bytes").cast(pa.large_binary())
        _, off_buf, data_buf = raw.buffers()
        offs = np.frombuffer(off_buf, np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(data_buf, np.uint8)[offs[0]:offs[-1]]
        self.width, self.offs = width, offs - offs[0]
        up, self.down = A.powers(len(data))
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(A.BYTE_VALUES[data] * up[:len(data)], out=self.total[1:])
        self.left = rows.column("left").to_numpy().astype(np.int64)
        self.anchor = rows.column("anchor").to_numpy().view(np.uint64)

    def windows(self, near: int = 0, far: int | None = None):
        """(row, first byte in the row, fingerprint) of the windows that begin
        ``near`` to ``far`` bytes before the anchor.  Windows are equal only
        at the same distance from equal anchors."""
        last = np.diff(self.offs) - self.width
        begin = np.zeros(len(last), np.int64) if far is None else np.maximum(self.left - far + 1, 0)
        each = np.maximum(np.minimum(last, self.left - near) - begin + 1, 0)
        row = np.repeat(np.arange(len(each)), each)
        start = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + begin[row]
        at = self.offs[row] + start
        text = A.mix((self.total[at + self.width] - self.total[at]) * self.down[at])
        distance = (self.left[row] - start).astype(np.uint64)
        return row, start, A.mix(A.mix(text + distance) ^ self.anchor[row])


def _repeated_windows(width: int):
    """Rows in order of the anchor -> windows that occur twice, in runs."""
    def intervals(rows: pa.RecordBatch) -> pa.RecordBatch:
        spans = _Spans(rows, width)
        hits = []
        for near in range(0, int(spans.left.max()) + 1, STRIPE):
            row, start, key = spans.windows(near, near + STRIPE)
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(key), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            hits.append((row[twice] << 32) | start[twice])
        found = np.sort(np.concatenate(hits))
        row, start = found >> 32, found & ((1 << 32) - 1)
        new = np.ones(len(found), dtype=bool)
        new[1:] = found[1:] != found[:-1] + 1
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(found)) - 1 if len(found) else first
        base = rows.column("begin").to_numpy()[row[first]]
        return pa.RecordBatch.from_arrays(
            [rows.column("id0").take(pa.array(row[first])), rows.column("th").take(pa.array(row[first])),
             pa.array(base + start[first]), pa.array(base + start[last] + width)],
            names=["id0", "th", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            anchor = batch.column("anchor").to_numpy()
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1], side="left"))  # the last anchor may go on
            held = batch.slice(cut)
            for part in range(0, cut, 4096) if cut else ():
                # Whole anchors at a time, some thousand rows together.
                a = part if not part else int(np.searchsorted(anchor, anchor[part], side="left"))
                b = cut if part + 4096 >= cut else int(np.searchsorted(anchor, anchor[part + 4096], side="left"))
                if b > a:
                    yield intervals(batch.slice(a, b - a))
        if held is not None and held.num_rows:
            yield intervals(held)
    return run


def _window_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                rows = batch.slice(at, 2048)
                row, start, key = _Spans(rows, width).windows()
                begin = rows.column("begin").to_numpy()[row] + start
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id0").take(pa.array(row)), rows.column("th").take(pa.array(row)),
                     pa.array(begin), pa.array(begin + width), _signed(key)],
                    names=["id0", "th", "begin", "end", "window"])
    return run


_INTERVAL = "id0 long, th long, begin long, end long"


def repeated_strings(docs: DataFrame, width: int = 200, batches: int = BATCHES,
                     class_size: int = CLASS) -> DataFrame:
    """(id0, th, begin, end): byte intervals (of the rows as ``keyed`` names
    them) whose every window of ``width`` bytes also starts elsewhere; they
    may overlap."""
    spark = docs.sparkSession
    rows = keyed(docs)
    family = SuffixFamily(spark, width)
    for b in range(batches):
        family.add(rows.where(F.pmod(F.xxhash64("id0", "th"), F.lit(batches)) == b))
    doubled = keep(family.matches(), "matches")
    edges = keep(family.entries().groupBy("anchor").agg(F.min("context").alias("lo"), F.max("context").alias("hi"))
                 .where("lo <> hi").select("anchor"), "edges")
    family.close()
    sc = spark.sparkContext
    found = keep(arrow_map(rows.select("id0", "th", "text"),
                           _placed(width, sc.broadcast(bloom(doubled.select("context"))),
                                   sc.broadcast(bloom(edges))), PLACED), "placed")
    whole = found.where("bytes is null").join(doubled, ["context", "anchor"]).select("id0", "th", "begin", "end")
    at_edge = found.where("bytes is not null")
    sizes = keep(at_edge.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "classes")
    usual = at_edge.join(sizes.where(F.col("n") <= class_size).select("anchor"), "anchor", "left_semi")
    large = at_edge.join(sizes.where(F.col("n") > class_size).select("anchor"), "anchor", "left_semi")
    columns = ["id0", "th", "anchor", "begin", "left", "bytes"]
    some = arrow_map(usual.select(*columns).repartition("anchor").sortWithinPartitions("anchor"),
                     _repeated_windows(width), _INTERVAL)
    each = keep(arrow_map(large.select(*columns), _window_rows(width), _INTERVAL + ", window long"), "windows")
    often = keep(each.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window"), "windows")
    more = each.join(often, "window", "left_semi").select("id0", "th", "begin", "end")
    return whole.union(some).union(more)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = pc.fill_null(batch.column("text"), "")
        out = []
        for text, begins, ends in zip(col, batch.column("begins").to_pylist(), batch.column("ends").to_pylist(),
                                      strict=True):
            raw = text.as_buffer()
            size = raw.size if raw is not None else 0
            data = np.frombuffer(raw, np.uint8) if size else np.zeros(0, np.uint8)
            if begins:
                step = np.zeros(size + 1, dtype=np.int32)
                np.add.at(step, begins, 1)
                np.add.at(step, ends, -1)
                gone = np.cumsum(step[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                data = data[~gone]
            else:
                runs = 0
            out.append((size, size - len(data), runs, data.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()),
             pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()),
             pa.array([x[3] for x in out], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cut in _cut(batches):
        sha = pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in cut.column("kept")], pa.string())
        yield pa.RecordBatch.from_arrays([*cut.columns[:4], sha],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, width: int = 200, batches: int = BATCHES, class_size: int = CLASS,
                   digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of ``docs``; kept
    holds the remaining bytes, or with ``digest`` kept_sha256 their SHA-256."""
    runs = (repeated_strings(docs, width, batches, class_size).groupBy("id0", "th")
            .agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")))
    joined = keyed(docs).join(runs, ["id0", "th"], "left").select("doc_id", "text", "begins", "ends")
    kept = "kept_sha256 string" if digest else "kept binary"
    return arrow_map(joined, _digested if digest else _cut,
                     f"doc_id long, n_bytes long, n_removed long, n_spans long, {kept}")
