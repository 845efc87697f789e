"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct ``width``-word shingles (64-bit
hashes).  One pass computes per document ``BANDS * ROWS`` minima under
linear hash functions.  The minima of a band form one bucket key; of every
minimum only its low ``BITS`` bits are retained, packed into longs.  Two
documents that share a bucket are a candidate pair; the number of equal
b-bit groups, counted by xor and bit count and corrected for chance
collisions, estimates their similarity; pairs whose estimate is not
hopeless (``MARGIN`` below the threshold, over five standard deviations)
are confirmed on their full shingle sets.

Nothing is dropped to escape large groups:

* documents of equal sets form one vertex, found by a digest;
* the first pass compares every member of a bucket with the bucket's
  smallest vertex only, so a group of copies costs as many pairs as members;
* the second pass takes the buckets whose members are not yet in one
  component and compares the members outside the bucket's largest component
  with all others of the bucket; all pairs of a bucket are then either
  compared or already connected.  Such buckets hold groups of documents just
  below the threshold, so their members get a longer signature first
  (``FINE`` minima, one bit each): its error is a third, and the pairs that
  need their full sets are those within ``FINE_MARGIN`` of the threshold.

With 32 bands of 4 rows a pair of similarity 0.75 shares no bucket with
probability (1 - 0.75^4)^32 = 5e-6.

Rows: a null or empty text, or one without words, has no shingles and is
its own component.  A null id takes no part: component null, not kept.
Rows that share an id are one vertex.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.bloom import bloom, maybe
from tallyspark.llm.frames import arrow_map, keep, other_key, texts
from tallyspark.llm.links import components

BANDS, ROWS, BITS = 32, 4, 2
MARGIN = 0.25
FINE, FINE_MARGIN = 2048, 0.07
_MUL = (A.seeds(FINE, 21) >> A.U64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (A.seeds(FINE, 22) >> A.U64(32)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int):
    """Distinct shingle hashes of each document, sorted, and their offsets."""
    starts, ends, first = A.word_spans(data, offs, A.SPACED)
    grams, at = A.grams(A.span_hashes(A.LOWER[data], starts, ends), first, width)
    sets = [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    bounds = np.zeros(len(sets) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return (np.concatenate(sets) if sets else grams), bounds


def _minima(values: np.ndarray, bounds: np.ndarray, functions: int) -> np.ndarray:
    """(documents, hash functions) minima; every document has a value."""
    x = (values >> A.U64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, functions), dtype=np.uint32)
    h = np.empty_like(x)
    for k, (m, c) in enumerate(zip(_MUL[:functions], _ADD[:functions], strict=True)):
        np.multiply(x, m, out=h)
        np.add(h, c, out=h)
        out[:, k] = np.minimum.reduceat(h, bounds[:-1])
    return out


def _bucket_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    by_band = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(A.seeds(BANDS, 23), (len(minima), BANDS)).copy()
    for r in range(ROWS):
        key = A.mix(key + by_band[:, :, r] * A.U64(A.GRAM_BASE))
    return key


def _packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of the (avalanched) minima, packed into longs."""
    lanes = 64 // bits
    low = A.mix(minima.astype(np.uint64)) & A.U64((1 << bits) - 1)
    shift = np.arange(lanes, dtype=np.uint64) * A.U64(bits)
    return (low.reshape(len(minima), -1, lanes) << shift).sum(axis=2, dtype=np.uint64)


_SIG_FIELDS = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
               ("keys", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))]
SIG_SCHEMA = "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, bits array<long>"


def _lists(matrix: np.ndarray, full: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists; documents without values get an empty one."""
    at = np.zeros(len(full) + 1, dtype=np.int32)
    np.cumsum(full * matrix.shape[1], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(matrix.reshape(-1).view(np.int64)))


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                values, bounds = shingle_sets(data, offs, width)
                size = np.diff(bounds)
                full = size > 0
                minima = _minima(values, np.append(bounds[:-1][full], bounds[-1]), BANDS * ROWS) if full.any() \
                    else np.zeros((0, BANDS * ROWS), np.uint32)
                digest = []
                for salt in (31, 32):
                    total = np.zeros(len(values) + 1, dtype=np.uint64)
                    np.cumsum(A.mix(values ^ A.seeds(1, salt)), out=total[1:])
                    digest.append(pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(size), *digest,
                     _lists(_bucket_keys(minima), full), _lists(_packed(minima, BITS), full)],
                    schema=pa.schema(_SIG_FIELDS))
    return run


def _wanted(batch: pa.RecordBatch, ids: np.ndarray) -> pa.RecordBatch:
    """The rows whose id may be in the filter."""
    known = pc.is_valid(batch.column("doc_id")).to_numpy(zero_copy_only=False)
    own = batch.column("doc_id").fill_null(0).to_numpy().view(np.uint64)
    return batch.filter(pa.array(known & maybe(ids, own)))


def _fine(width: int, ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in A.chunks(_wanted(batch, ids.value), limit=A.CHUNK // 4):
                values, bounds = shingle_sets(data, offs, width)
                full = np.diff(bounds) > 0
                minima = _minima(values, np.append(bounds[:-1][full], bounds[-1]), FINE) if full.any() \
                    else np.zeros((0, FINE), np.uint32)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), _lists(_packed(minima, 1), full)],
                                                 schema=pa.schema([("doc_id", pa.int64()),
                                                                   ("bits", pa.list_(pa.int64()))]))
    return run


def _sets(width: int, ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in A.chunks(_wanted(batch, ids.value)):
                values, bounds = shingle_sets(data, offs, width)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))],
                    schema=pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))]))
    return run


def signatures(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, keys, bits): set size, digest, bucket
    keys and packed b-bit signature of every document."""
    return arrow_map(texts(docs), _signatures(width), SIG_SCHEMA)


def estimate(x: str, y: str, functions: int, bits: int) -> Column:
    """Similarity estimated from two packed signatures, corrected for the
    chance that ``bits`` bits agree.  A lambda over the longs keeps the
    generated code of a join condition small enough to be compiled."""
    groups = sum(1 << (bits * i) for i in range(64 // bits))
    groups -= (groups >> 63) << 64  # as a signed long

    def unequal(a: Column, b: Column) -> Column:
        diff = a.bitwiseXOR(b)
        for s in range(1, bits):
            diff = diff.bitwiseOR(F.shiftrightunsigned(diff, s))
        return F.bit_count(diff if bits == 1 else diff.bitwiseAND(F.lit(groups).cast("long")))

    total = F.aggregate(F.zip_with(x, y, unequal), F.lit(0), lambda s, v: s + v)
    chance = 1.0 / (1 << bits)
    return (1 - total / F.lit(float(functions)) - chance) / (1 - chance)


def _size_fits(threshold: float) -> Column:
    return F.least("n1", "n2") >= threshold * F.greatest("n1", "n2")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs whose full sets reach the similarity."""
    with_a = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = with_a.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - inter
    return both.where(100 * inter >= percent * union).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union|
    of their shingle sets; the component is the smallest id reachable over
    links, and the document of that id is the one to keep.
    """
    plain = texts(docs)
    threshold = percent / 100
    sigs = keep(signatures(docs, width), "signatures")
    known = sigs.where("n_shingles > 0 and doc_id is not null")
    # One vertex per distinct set: its smallest document.
    groups = keep(known.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")),
                  "sets")
    nodes = keep(known.join(groups.where("node is not null").withColumnRenamed("node", "doc_id"),
                            ["doc_id", "d1", "d2"], "left_semi")
                 .dropDuplicates(["doc_id", "d1", "d2"])
                 .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "keys", "bits"), "nodes")
    buckets = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    heads = keep(buckets.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("members"))
                 .where("members > 1").select("key", "head"), "buckets")

    # First pass: every member against the smallest vertex of its buckets.
    again = heads.select(other_key(F.col("key")).alias("k"), "key", "head")
    entries = keep(buckets.withColumn("k", other_key(F.col("key"))).drop("key")
                   .join(again, "k").select("key", "head", "node", "band"), "entries")
    star = entries.where("node <> head").select("head", "node").distinct()
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("bits1"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))
    first = keep(star.select(F.col("head").alias("a"), F.col("node").alias("b"))
                 .join(two, "b").join(one, "a")
                 .where(_size_fits(threshold) & (estimate("bits1", "bits2", BANDS * ROWS, BITS) >= threshold - MARGIN))
                 .select("a", "b"), "pairs")
    sets = _sets_of(plain, first, width)
    links = keep(_confirmed(first, sets, percent), "confirmed")
    part = keep(components(links), "parts")

    # Second pass: buckets that hold several components.
    placed = (entries.join(part, "node", "left")
              .select("key", "node", "band", F.coalesce("component", "node").alias("part")))
    by_part = keep(placed.groupBy("key", "part").agg(F.count("*").alias("members")), "bucket_parts")
    mixed = keep(by_part.groupBy("key").agg(F.count("*").alias("parts"),
                                            F.max_by("part", F.struct("members", "part")).alias("largest"))
                 .where("parts > 1").select("key", "largest"), "mixed")
    again = mixed.select(other_key(F.col("key")).alias("k"), "largest")
    full = keep(placed.withColumn("k", other_key(F.col("key"))).join(again, "k")
                .select("key", "node", "band", "part", "largest"), "mixed_entries")
    ids = _id_filter(full.select(F.col("node").alias("doc_id")).distinct())
    fine = keep(arrow_map(plain, _fine(width, ids), "doc_id long, bits array<long>")
                .select(F.col("doc_id").alias("node"), F.col("bits").alias("fine")), "fine_signatures")
    # A pair is met in the first bucket it shares.
    full = full.join(nodes.select("node", "n", "bits", "keys").join(fine, "node"), "node").withColumn(
        "earlier", F.slice("keys", F.lit(1), F.col("band"))).drop("keys")
    rest = full.where("part <> largest").select(
        "key", F.col("node").alias("x"), F.col("part").alias("part1"), F.col("n").alias("n1"),
        F.col("bits").alias("bits1"), F.col("fine").alias("fine1"), F.col("earlier").alias("earlier1"))
    every = full.select("key", F.col("node").alias("y"), F.col("part").alias("part2"), F.col("n").alias("n2"),
                        F.col("bits").alias("bits2"), F.col("fine").alias("fine2"),
                        F.col("earlier").alias("earlier2"))
    met = rest.join(every, (rest["key"] == every["key"]) & (F.col("part1") != F.col("part2")) & _size_fits(threshold)
                    & ~F.arrays_overlap("earlier1", "earlier2")
                    & (estimate("bits1", "bits2", BANDS * ROWS, BITS) >= threshold - MARGIN)
                    & (estimate("fine1", "fine2", FINE, 1) >= threshold - FINE_MARGIN))
    second = keep(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
                  .join(first, ["a", "b"], "left_anti"), "pairs")
    more = _confirmed(second, _sets_of(plain, second, width), percent)
    # A document id that stands for several sets joins them.
    joined = (known.join(groups, ["d1", "d2"]).where("doc_id <> node").select("doc_id", "node", "d1", "d2"))
    several = known.groupBy("doc_id").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).where("lo <> hi")
    same_id = joined.join(several.select("doc_id"), "doc_id", "left_semi").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b"))
    whole = keep(components(links.union(more).union(same_id)), "components")

    reps = keep(groups.join(whole, "node", "left")
                .where("copies > 1 or component is not null")
                .select(F.col("d1").alias("e1"), F.col("d2").alias("e2"),
                        F.coalesce("component", "node").alias("component")), "representatives")
    own = (sigs["d1"] == reps["e1"]) & (sigs["d2"] == reps["e2"]) & (sigs["n_shingles"] > 0)
    return (sigs.select("doc_id", "n_shingles", "d1", "d2").join(reps, own, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _sets_of(plain: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Shingle sets of the documents that occur in candidate pairs (and of a
    few more that the filter lets pass)."""
    ids = _id_filter(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    return keep(arrow_map(plain, _sets(width, ids), "doc_id long, shingles array<long>"), "shingles")


def _id_filter(ids: DataFrame):
    """Broadcast filter over ids, so that texts are not shuffled to find a
    few documents again."""
    return ids.sparkSession.sparkContext.broadcast(bloom(ids))
