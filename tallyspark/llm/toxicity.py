"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens.  A word's score is the log odds that a labelled document with it is
toxic, against the base rate, less ``DRIFT``.  The rates have Dirichlet
priors in a chain: the base rate is the prior of the first four bytes, that
of the first six bytes, that of the word; each prior weighs ``PRIOR``
documents.  Counts are of documents, hashed into tables of fixed size.

Passages.  One scan over a text's scores finds all its maximal scoring
segments (each one cannot be extended or shortened without loss), in time
linear in the words.

Calibration.  With lambda, the positive root of E[exp(lambda * score)] = 1
over the tokens of all documents, segment scores of unrelated text follow an
extreme-value law: log(expected number of such segments in n tokens) is
log(K n) - lambda S.  K is fitted to the best segments of the non-toxic
labelled documents.  The normal scores lambda S - log(K n) of all segments of
a text are its evidence: the best one, the sum of the significant ones and
their number; a logistic curve over the labelled sample turns it into a
probability.  Only there, in fitting, a labelled document's own counts are
left out of its scores: a score is a function of the text alone.

The labelled sample is the only part that does not grow: the ``SAMPLE``
distinct (id, label) pairs with the smallest hash of the id, from the training
folds, each with one text (as in ``quality``).

Null and empty texts and texts without words have no segments and score like
any text without evidence; without labels of both kinds every score is the
share of label 1 (0 without any).  Rows map one to one: null and repeated
ids, ties and extra columns change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.frames import arrow_map, fold, keep, texts
from tallyspark.llm.quality import labelled_sample

WORDS, STEMS = 1 << 19, 1 << 17
TABLE = WORDS + 2 * STEMS
PRIOR, DRIFT, HIGH = 3.0, 1.0, 8.0
SAMPLE = 1 << 16
BINS = 512
LOW = -4.0


def slots(data: np.ndarray, offs: np.ndarray):
    """(word, stem of six, stem of four) table places of every word, and per
    document the first one's index."""
    low = A.LOWER[data]
    starts, ends, first = A.word_spans(low, offs, A.ALNUM)
    word = (A.span_hashes(low, starts, ends) % A.U64(WORDS)).astype(np.int64)
    six, four = ((A.span_hashes(low, starts, np.minimum(starts + n, ends)) % A.U64(STEMS)).astype(np.int64)
                 for n in (6, 4))
    return word, six + WORDS, four + WORDS + STEMS, first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = {0: np.zeros(TABLE, np.int64), 1: np.zeros(TABLE, np.int64)}
    for batch in batches:
        for rows, data, offs in A.chunks(batch):
            *places, first = slots(data, offs)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(first))
            label = rows.column("label").to_numpy()
            for place in places:
                pair = np.unique(doc * TABLE + place)
                y = label[pair // TABLE]
                for kind in (0, 1):
                    held[kind] += np.bincount(pair[y == kind] % TABLE, minlength=TABLE)
    at = np.flatnonzero(held[0] + held[1])
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[0][at]), pa.array(held[1][at])],
                                     names=["place", "clean", "toxic"])


class Scores:
    """Token scores from the counts of labelled documents."""

    def __init__(self, every: np.ndarray, toxic: np.ndarray, base: float):
        self.every, self.toxic, self.base = every.astype(np.float32), toxic.astype(np.float32), base
        self.zero = math.log(base / (1 - base))

    def __call__(self, places, own: np.ndarray | None = None) -> np.ndarray:
        """Scores of tokens; ``own`` is the label of the token's document,
        whose counts are taken off."""
        word, six, four = places
        rate = self.base
        out, own = (0, 0) if own is None else (1, own)
        for place in (four, six, word):
            rate = ((self.toxic[place] - own + PRIOR * rate) / (self.every[place] - out + PRIOR))
        rate = np.clip(rate, 1e-5, 1 - 1e-5)
        return np.clip(np.log(rate / (1 - rate)) - self.zero - DRIFT, LOW, HIGH)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(first, end, score) of all maximal scoring segments, in order.

    Only tokens of positive score are visited; the running sums carry the
    rest.  A new candidate joins back to the nearest one that starts lower,
    if its end is lower too; every candidate is merged away once.
    """
    total = np.cumsum(scores, dtype=np.float64)
    at = np.flatnonzero(scores > 0)
    found: list[list] = []  # first, end, sum before, sum at the end, nearest earlier one that starts lower
    before = (total[at] - scores[at]).tolist()
    after = total[at].tolist()
    for i, low, high in zip(at.tolist(), before, after, strict=True):
        first, j = i, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
            j -= 1
        found.append([first, i + 1, low, high, j])
    return [(f[0], f[1], f[3] - f[2]) for f in found]


def _tokens(rows: pa.RecordBatch, data, offs, scores: Scores, left_out: bool = False):
    """Scores of all tokens, and per document the first one's index."""
    *places, first = slots(data, offs)
    own = np.repeat(rows.column("label").to_numpy().astype(np.float32), np.diff(first)) if left_out else None
    return scores(places, own), first


def _segments(token: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, float]]]:
    return [maximal_segments(token[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _histogram(shared):
    """Histogram of the token scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BINS, np.int64)
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                token, _ = _tokens(rows, data, offs, shared.value)
                held += np.bincount(((token - LOW) / (HIGH - LOW) * (BINS - 1)).astype(np.int64), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(held)], names=["bin", "tokens"])
    return run


def _sample_segments(shared):
    """Token count and scores of all segments of the labelled documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                token, first = _tokens(rows, data, offs, shared.value, left_out=True)
                found = [[s for *_, s in x] for x in _segments(token, first)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("label"), pa.array(np.diff(first)), pa.array(found, pa.list_(pa.float64()))],
                    names=["label", "n", "segments"])
    return run


def decay(histogram: np.ndarray) -> float:
    """lambda: the positive root of E[exp(lambda * score)] = 1."""
    value = LOW + np.arange(BINS) / (BINS - 1) * (HIGH - LOW)
    share = histogram / max(histogram.sum(), 1)
    low, high = 1e-3, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * value)).sum() < 1 else (low, mid)
    return (low + high) / 2


class Evidence:
    """Extreme-value normal scores of a document's segments."""

    def __init__(self, rate: float, log_k: float):
        self.rate, self.log_k = rate, log_k

    def normal(self, score: float, n: int) -> float:
        return self.rate * score - self.log_k - math.log(max(n, 1))

    def __call__(self, scores: list[float], n: int) -> list[float]:
        z = [self.normal(s, n) for s in scores]
        good = [x for x in z if x > 0]
        return [max(z, default=-10.0), math.log1p(sum(good)), math.log1p(len(good)), 1.0]

    def columns(self) -> list[Column]:
        """The same from the columns ``segments`` and ``n``."""
        z = F.transform("segments", lambda s: s * self.rate - self.log_k - F.log(F.greatest("n", F.lit(1))))
        good = F.filter(z, lambda x: x > 0)
        total = F.aggregate(good, F.lit(0.0), lambda a, x: a + x)
        return [F.coalesce(F.array_max(z), F.lit(-10.0)).alias("best"), F.log1p(total).alias("total"),
                F.log1p(F.size(good)).alias("number"), F.lit(1.0).alias("one")]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1]),
                               x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> dict:
    """The bounded model: score tables, extreme-value law and curve."""
    sc = docs.sparkSession.sparkContext
    known = labelled_sample(docs, labels, label, sample)
    counted = (arrow_map(known, _count, "place long, clean long, toxic long")
               .groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    every, toxic = np.zeros(TABLE), np.zeros(TABLE)
    at = counted.column("place").to_numpy()
    toxic[at] = counted.column("toxic").to_numpy()
    every[at] = counted.column("clean").to_numpy() + toxic[at]
    base = float((toxic[:WORDS].sum() + 0.5) / (every[:WORDS].sum() + 1.0))
    scores = Scores(every, toxic, base)
    shared = sc.broadcast(scores)
    totals = (arrow_map(texts(docs).select("text"), _histogram(shared), "bin long, tokens long")
              .groupBy("bin").agg(F.sum("tokens").alias("tokens")).toArrow())
    histogram = np.zeros(BINS)
    histogram[totals.column("bin").to_numpy()] = totals.column("tokens").to_numpy()
    rate = decay(histogram)
    found = keep(arrow_map(known, _sample_segments(shared), "label int, n long, segments array<double>"), "segments")
    clean = found.where("label = 0 and size(segments) > 0").select("n", F.array_max("segments").alias("best")).toArrow()
    tops = rate * clean.column("best").to_numpy() - np.log(clean.column("n").to_numpy())
    law = Evidence(rate, (float(np.median(tops)) + math.log(math.log(2))) if len(tops) else 0.0)
    seen = found.select("label", *law.columns()).toArrow()  # a row of the sample each
    y = seen.column("label").to_numpy().astype(np.float64)
    curve = None
    if len(y) and 0 < y.sum() < len(y):
        curve = _logistic(np.stack([seen.column(c).to_numpy() for c in seen.column_names[1:]], axis=1), y)
    return {"scores": shared, "law": law, "curve": curve, "prior": float(y.mean()) if len(y) else 0.0}


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.3,
          sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) for every row of
    ``docs``; passages holds (first word, words, normal score) of the
    significant segments."""
    model = fit(docs, labels, label, sample)
    shared, law, curve, prior = model["scores"], model["law"], model["curve"], model["prior"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("z", pa.float64())]))
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                token, first = _tokens(rows, data, offs, shared.value)
                p, spans = [], []
                for n, found in zip(np.diff(first).tolist(), _segments(token, first), strict=True):
                    x = law([s for *_, s in found], n)
                    p.append(prior if curve is None else
                             1 / (1 + math.exp(-min(30, max(-30, float(np.dot(curve, x)))))))
                    z = [(a, b - a, law.normal(s, n)) for a, b, s in found]
                    spans.append([{"first": a, "words": w, "z": v} for a, w, v in z if v > 0])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(p, pa.float64()), pa.array(spans, kind)],
                    names=["doc_id", "score", "passages"])

    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    out = arrow_map(texts(docs), run,
                    "doc_id long, score double, passages array<struct<first:long,words:long,z:double>>")
    return out.select("doc_id", held_out.alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
