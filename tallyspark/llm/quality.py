"""Quality scores by voting of the nearest labelled documents.

Features.  Every word of a text counts in five ways: as itself, by the kind
of its first bytes (upper, lower, digit, other), by the kind of its last
bytes, by its length, and by whether it repeats the word before it; each is
hashed into its own range of ``DIMS`` features.  A document is the vector of
1 + log counts times inverse document frequency (over all documents), with
the four ranges of form weighted up by ``FORM_WEIGHT``, at unit length.

Latent space.  The vectors of the labelled sample are factored by a truncated
singular value decomposition (subspace iteration); documents are projected on
the leading ``RANK`` directions.

Vote.  The sample's projections are broadcast: at most ``SAMPLE`` rows of
``RANK`` floats.  Each task multiplies blocks of documents with them; the
``NEIGHBOURS`` most similar labelled documents vote with their label, weighted
by the ``SHARPNESS`` power of their cosine.  The score is a function of the
text alone: equal texts score alike, whatever their ids.

The sample is the only part that does not grow: the ``SAMPLE`` distinct (id,
label) pairs with the smallest hash of the id, from the training folds, each
with one text.

Null and empty texts have no features; they, and all documents if nothing is
labelled, get the share of label 1 in the sample (0.5 without one).  A label
that is null does not count; labels that differ on one id are both in the
sample.  Of several documents with one id the one with the smallest hash of
its text (a null text last) is in the sample.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.frames import arrow_map, fold, smallest_hashes, texts

WORD_DIMS, FORM_DIMS = 3072, 256
DIMS = WORD_DIMS + 4 * FORM_DIMS
FORM_WEIGHT = 4.0
RANK = 96
SAMPLE = 6144
NEIGHBOURS = 24
SHARPNESS = 4
BLOCK = 256
#: Kinds of bytes: lower, upper, digit, beyond ASCII count as letters; others by themselves.
KIND = np.array([1 if 97 <= b <= 122 or b >= 128 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else b
                 for b in range(256)], dtype=np.uint64)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every occurrence."""
    starts, ends, first = A.word_spans(data, offs, A.SPACED)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    if not len(starts):
        return doc, doc
    word = A.span_hashes(A.LOWER[data], starts, ends)
    size = ends - starts
    kind = KIND[data]
    head = kind[starts] * A.U64(256) + kind[np.minimum(starts + 1, ends - 1)]
    tail = (kind[ends - 1] * A.U64(65536) + kind[np.maximum(ends - 2, starts)] * A.U64(256)
            + kind[np.maximum(ends - 3, starts)])
    again = np.zeros(len(word), dtype=np.uint64)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    forms = [head, tail, np.minimum(size, 40).astype(np.uint64), again]
    cols = [word % A.U64(WORD_DIMS)]
    for k, f in enumerate(forms):
        cols.append(A.mix(f + A.seeds(1, 51 + k)) % A.U64(FORM_DIMS) + A.U64(WORD_DIMS + k * FORM_DIMS))
    return np.tile(doc, 5), np.concatenate(cols).astype(np.int64)


def _counts(data: np.ndarray, offs: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Dense counts of documents begin..end of a chunk."""
    lo, hi = int(offs[begin]), int(offs[end])
    doc, feature = features(data[lo:hi], offs[begin:end + 1] - lo)
    n = end - begin
    return np.bincount(doc * DIMS + feature, minlength=n * DIMS).reshape(n, DIMS)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for rows, data, offs in A.chunks(batch):
        for at in range(0, rows.num_rows, BLOCK):
            to = min(at + BLOCK, rows.num_rows)
            yield rows.slice(at, to - at), _counts(data, offs, at, to)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(DIMS, dtype=np.int64)
    docs = 0
    for batch in batches:
        for _, counts in _blocks(batch):
            held += (counts > 0).sum(axis=0)
            docs += len(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMS), -1)), pa.array(np.append(held, docs))],
                                     names=["feature", "docs"])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each feature, over all documents, and their number."""
    rows = (arrow_map(texts(docs).select("text"), _frequencies, "feature long, docs long")
            .groupBy("feature").agg(F.sum("docs").alias("docs")).collect())
    found = {r.feature: r.docs for r in rows}
    return np.array([found.get(k, 0) for k in range(DIMS)], dtype=np.float64), found.get(-1, 0)


def inverse_frequencies(held: np.ndarray, docs: int) -> np.ndarray:
    out = np.log((1.0 + docs) / (1.0 + held)) + 0.1
    out[WORD_DIMS:] *= FORM_WEIGHT
    return out.astype(np.float32)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def sample_labels(labels: DataFrame, label: str, size: int, parts: int = 4, left_out: int = 2) -> DataFrame:
    """(doc_id, label), distinct, at most ``size`` of them, outside the left-out fold."""
    return smallest_hashes(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), parts) != left_out)).distinct(), size)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, text, label) of the sample, one row for each pair of an id and
    a label; the pairs are broadcast, which ``size`` bounds.  Only the texts of
    ids that several documents have are shuffled."""
    pairs = texts(docs).join(F.broadcast(sample_labels(labels, label, size)), "doc_id")
    shared = F.broadcast(pairs.groupBy("doc_id", "label").agg(F.count("*").alias("n")).where("n > 1")
                         .select("doc_id", "label"))
    least = F.min(F.struct(F.col("text").isNull(), F.xxhash64("text"), "text"))["text"]
    several = (pairs.join(shared, ["doc_id", "label"], "left_semi").groupBy("doc_id", "label")
               .agg(least.alias("text")))
    return (pairs.join(shared, ["doc_id", "label"], "left_anti").select("doc_id", "text", "label")
            .union(several.select("doc_id", "text", "label")))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-zero counts of each document, for the bounded sample only."""
    for batch in batches:
        for rows, counts in _blocks(batch):
            idx = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("label"), pa.array([i.tolist() for i in idx], pa.list_(pa.int32())),
                 pa.array([c[i].tolist() for i, c in zip(idx, counts, strict=True)], pa.list_(pa.int32()))],
                names=["doc_id", "label", "features", "counts"])


def latent_space(vectors: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors (features x rank), by subspace iteration."""
    rank = min(rank, *vectors.shape)
    basis = np.random.default_rng(7).standard_normal((vectors.shape[1], rank + 16)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(vectors.T @ (vectors @ basis))
    _, _, turn = np.linalg.svd(vectors @ basis, full_matrices=False)
    return (basis @ turn[:rank].T).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> dict:
    """The bounded model: feature weights, latent directions, labelled points."""
    held, n = document_frequencies(docs)
    idf = inverse_frequencies(held, n)
    rows = arrow_map(labelled_sample(docs, labels, label, sample), _sparse,
                     "doc_id long, label int, features array<int>, counts array<int>").toArrow()
    ids, y = rows.column("doc_id").to_numpy(), rows.column("label").to_numpy()
    size = rows.column("features").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    # Rows with features, in order of id and label; one dense matrix, worked on in place.
    order = np.lexsort((y, ids))
    order = order[size[order] > 0]
    if not len(order):
        return {"idf": idf, "prior": 0.5, "space": None}
    place = np.full(len(ids), -1)
    place[order] = np.arange(len(order))
    v = np.zeros((len(order), DIMS), dtype=np.float32)
    v[np.repeat(place, size), rows.column("features").combine_chunks().flatten().to_numpy()] = \
        rows.column("counts").combine_chunks().flatten().to_numpy()
    del rows
    np.log1p(v, out=v)
    v *= idf
    for k in range(0, len(v), BLOCK):
        v[k:k + BLOCK] /= np.maximum(np.linalg.norm(v[k:k + BLOCK], axis=1, keepdims=True), 1e-12)
    y = y[order].astype(np.float32)
    space = latent_space(v, RANK)
    points = v @ space
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    return {"idf": idf, "prior": float(y.mean()), "space": space, "points": points, "labels": y}


def vote(model: dict, counts: np.ndarray) -> np.ndarray:
    """Score of each document of a block."""
    out = np.full(len(counts), model["prior"])
    full = np.flatnonzero(counts.any(axis=1))
    if model["space"] is None or not len(full):
        return out
    at = _vectors(counts[full], model["idf"]) @ model["space"]
    at /= np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-12)
    cos = at @ model["points"].T
    k = min(NEIGHBOURS, cos.shape[1])
    near = np.argpartition(cos, -k, axis=1)[:, -k:]
    weight = np.maximum(np.take_along_axis(cos, near, axis=1), 1e-6).astype(np.float64) ** SHARPNESS
    out[full] = (weight * model["labels"][near]).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0.0, 1.0)


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7,
          sample: int = SAMPLE, rest: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; ``rest``
    names further columns to keep, among them ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, counts in _blocks(batch):
                kept = [rows.column(f"r{k}") for k in range(len(rest))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *kept, pa.array(vote(model, counts))],
                    names=["doc_id", *(f"r{k}" for k in range(len(rest))), "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(f"`{c}`").alias(f"r{k}") for k, c in enumerate(rest)])
    schema = rows.drop("text").schema.add("score", "double")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return (arrow_map(rows, run, schema)
            .select("doc_id", *[F.col(f"r{k}").alias(c) for k, c in enumerate(rest)], held_out.alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
