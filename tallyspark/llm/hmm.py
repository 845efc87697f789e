"""Document likelihoods under a hidden Markov model of words.

Tokens are the lower-cased words of a text and one end token.  The corpus
counts of all training tokens form a table (it grows with the corpus and is
only joined).  A token that occurs ``FEWEST`` times or more has emission
probabilities of its own (the ``CLASSES`` most frequent ones where there are
more, which bounds the model); the others form one class more, inside which a
token has the share (c + 1) / R, with R the sum over all rare tokens and one
unknown.  The model is thus a distribution over all token sequences that end.

Training.  Baum-Welch: each task runs the scaled forward and backward
recursions over its documents and sums expected counts; the sums are added up
block by block where Spark gathers them, and the driver normalises them
(states x classes numbers, whatever the corpus).  Every round runs over all
training documents; the class sequences of all documents are written once.
The number of partitions follows the tokens, up to ``WAVES`` for each core, so
the sums do not grow with the input splits.  Rounds end when the likelihood of
the training text, relative to the unigram's, rises by less than ``GAIN`` per
token, after ``ROUNDS`` at the latest; it is reported for each round
(``Model.history``).  Expected counts are taken in single precision.
Emissions are smoothed with the unigram of the classes.

Long texts.  A text of over ``STRETCH`` tokens is worked on in stretches, and
exactly so: from each state at once a stretch gives its transfer matrix; the
products of the matrices before and behind it are the state it is entered
with and the weights it is left with, so nothing is cut off at a border.

Scoring is the exact forward recursion over whole texts, by the same
matrices, in double precision.

Counts of the ``KNOWN`` most frequent tokens are broadcast (a fixed bound);
those of rarer tokens come by a join on the token, which no frequent token
enters.  Null texts are empty: the end token alone.  A document without an id
is scored, but not learned from.  Every row has its own result, so repeated
ids and rows do no harm.  Extra columns are ignored.  Tokens are told apart
by 64-bit hashes.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.frames import arrow_map, fold, keep, texts

STATES = 8
CLASSES, KNOWN = 1 << 18, 1 << 19
#: Occurrences of a token with emissions of its own.
FEWEST = 3
#: Occurrences of a token with emissions of its own.
FEWEST = 3
STRETCH = 2048
#: Tokens whose expected counts are taken at once.
PIECE = 1 << 19
ROUNDS, GAIN = 6, 1e-3
#: Steps between two scalings in training: ratios to the unigram are far from the range of single floats.
SCALED = 4
#: Tokens of a training partition at least, and the most partitions for a core.
PART, WAVES = 1 << 23, 16
#: Rows of the sums that travel together.
BLOCK = 4096
SMOOTH = 1500.0
#: Distinct tokens that a counting task holds before it passes them on.
HELD = 1 << 20


def token_hashes(data: np.ndarray, offs: np.ndarray):
    """Hashes of all words, and per document the first one's index."""
    low = A.LOWER[data]
    starts, ends, first = A.word_spans(low, offs, A.SPACED)
    return A.span_hashes(low, starts, ends).view(np.int64), first


def _added(a, b):
    token, back = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return token, np.bincount(back, weights=np.concatenate([a[1], b[1]])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = lambda h: pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1])], names=["token", "c"])
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    held, fresh = empty, []
    for batch in batches:
        for _, data, offs in A.chunks(batch):
            fresh.append(np.unique(token_hashes(data, offs)[0], return_counts=True))
            if len(fresh) >= 8:
                for x in fresh:
                    held = _added(held, x)
                fresh = []
                if len(held[0]) > HELD:
                    yield out(held)
                    held = empty
    for x in fresh:
        held = _added(held, x)
    yield out(held)


def _slots(known: np.ndarray) -> np.ndarray:
    """Hash table over the words' hashes: places in ``known``, -1 where empty."""
    out = np.full(1 << max(1, (2 * len(known)).bit_length()), -1, np.int32)
    mask = len(out) - 1
    left, slot = np.arange(len(known)), known & mask
    while len(left):
        free = out[slot] < 0
        out[slot[free]] = left[free]  # of several the last one stays
        on = out[slot] != left
        left, slot = left[on], (slot[on] + 1) & mask
    return out


class Model:
    """Counts and parameters; what is broadcast."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, tokens: int, types: int, ends: int,
                 states: int, classes: int):
        order = np.lexsort((known, -counts))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        by_token = np.argsort(known)
        self.known, self.counts = known[by_token], counts[by_token]
        self.rank = rank[by_token]
        self.slots = _slots(self.known)
        self.n = min(classes, int((counts >= FEWEST).sum()))  # classes 0..n-1 are tokens, n is rare, n + 1 the end
        self.tokens, self.types, self.ends, self.states = tokens, types, ends, states
        self.all_mass = float(tokens + types + 1)
        top = counts[order][:self.n]
        self.rare_mass = self.all_mass - float((top + 1).sum()) - (ends + 1 if ends else 0)
        mass = np.concatenate([top + 1.0, [self.rare_mass, ends + 1.0 if ends else 1.0]])
        self.unigram = mass / mass.sum()
        rng = np.random.default_rng(5)
        self.start = np.full(states, 1.0 / states)
        self.history: list[float] = []
        self.move = np.full((states, states), 0.01 / max(states - 1, 1))
        np.fill_diagonal(self.move, 0.99 if states > 1 else 1.0)
        self.emit = self.unigram[:, None] * np.exp(rng.standard_normal((len(self.unigram), states)))
        self.emit /= self.emit.sum(axis=0)

    def place(self, tokens: np.ndarray):
        """(class, count) of each word; the count is -1 if it isn't known here."""
        if not len(self.known):
            return np.full(len(tokens), self.n), np.full(len(tokens), -1, np.int64)
        mask = len(self.slots) - 1
        at = np.full(len(tokens), -1, np.int64)
        left, slot = np.arange(len(tokens)), tokens & mask
        while len(left):  # open addressing: a word is in its slot or behind it, before an empty one
            found = self.slots[slot]
            hit = self.known[found] == tokens[left]
            at[left[hit & (found >= 0)]] = found[hit & (found >= 0)]
            on = ~hit & (found >= 0)
            left, slot = left[on], (slot[on] + 1) & mask
        hit = at >= 0
        return (np.where(hit & (self.rank[at] < self.n), self.rank[at], self.n),
                np.where(hit, self.counts[at], -1))

    def parameters(self) -> Model:
        """Without the words: what the recursions need."""
        light = copy.copy(self)
        light.known = light.counts = light.rank = light.slots = None
        return light

    def learn(self, start, move, emit) -> None:
        """Maximisation from expected counts."""
        k = self.states
        self.start = (start + 0.5) / (start.sum() + 0.5 * k)
        move = move + 0.5
        self.move = move / move.sum(axis=1, keepdims=True)
        emit = emit + SMOOTH * self.unigram[:, None]
        self.emit = emit / emit.sum(axis=0)


def _sequences(model: Model, data: np.ndarray, offs: np.ndarray):
    """Classes of all tokens with the ends put in, offsets per document, and
    the words' classes and counts."""
    tokens, first = token_hashes(data, offs)
    kind, count = model.place(tokens)
    n = len(offs) - 1
    bounds = first + np.arange(n + 1)
    out = np.full(bounds[-1], model.n + 1, dtype=np.int64)
    doc = np.repeat(np.arange(n), np.diff(first))
    out[np.arange(len(tokens)) + doc] = kind
    return out, bounds, tokens, first, kind, count


def _stretches(bounds: np.ndarray):
    """(begin, length, document, is first) of the stretches, longest first."""
    size = np.diff(bounds)
    each = -(-size // STRETCH)
    doc = np.repeat(np.arange(len(size)), each)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    begin = bounds[:-1][doc] + number * STRETCH
    length = np.minimum(bounds[1:][doc] - begin, STRETCH)
    order = np.argsort(-length, kind="stable")
    return begin[order], length[order], doc[order], number[order]


def _active(length: np.ndarray) -> np.ndarray:
    """How many stretches (longest first) reach each step."""
    return np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")


def _forward(model: Model, seq, begin, length, alpha: np.ndarray, copies: int):
    """Scaled forward pass over stretches (longest first) from ``copies``
    vectors each: log of the scale and the state at the end.  A single vector
    is that of the first token, several are those before it."""
    b, n = np.repeat(begin, copies), np.repeat(length, copies)
    log, end, one = np.zeros(len(b)), np.empty_like(alpha), np.ones(model.states)
    live = _active(n) if len(n) else []
    for t, m in enumerate(live):
        alpha = alpha[:m] if not t and copies == 1 else alpha[:m] @ model.move
        alpha = alpha * model.emit.take(seq[b[:m] + t], axis=0)
        rest = live[t + 1] if t + 1 < len(live) else 0
        first = 0 if t % 8 == 7 else rest  # all are scaled now and then, those that end here in any case
        if first < m:
            s = alpha[first:] @ one
            log[first:m] += np.log(s)
            alpha[first:] /= s[:, None]
        end[rest:m] = alpha[rest:]
    return log, end


def _transfers(model: Model, seq, begin, length, number):
    """(stretch -> place, scaled matrices, logs of their scales) of all
    stretches but the first ones of texts."""
    k = model.states
    rest = np.flatnonzero(number > 0)
    matrices, scales = np.empty((len(rest), k, k)), np.empty(len(rest))
    for at in range(0, len(rest), 4096):
        rows = rest[at:at + 4096]
        log, end = _forward(model, seq, begin[rows], length[rows], np.tile(np.eye(k), (len(rows), 1)), k)
        log, end = log.reshape(-1, k), end.reshape(-1, k, k)
        top = log.max(axis=1)
        scales[at:at + len(rows)] = top
        matrices[at:at + len(rows)] = np.exp(log - top[:, None])[:, :, None] * end
    return rest, matrices, scales


def _edges(model: Model, seq, begin, length, doc, number):
    """Per stretch the state that it is entered with (of the token before, or
    of its first token where it begins a text) and the weights of the states
    that it is left with."""
    entry = np.tile(model.start, (len(begin), 1))
    leave = np.ones_like(entry)
    rest, matrices, _ = _transfers(model, seq, begin, length, number)
    if not len(rest):
        return entry, leave
    heads = np.flatnonzero((number == 0) & np.isin(doc, doc[rest]))
    _, end = _forward(model, seq, begin[heads], length[heads], entry[heads], 1)
    state = dict(zip(doc[heads].tolist(), end, strict=True))
    place = {(d, m): r for d, m, r in zip(doc.tolist(), number.tolist(), range(len(doc)), strict=True)
             if d in state}
    order = sorted(zip(doc[rest].tolist(), number[rest].tolist(), range(len(rest)), strict=True))
    for d, m, i in order:
        entry[place[d, m]] = state[d]
        v = state[d] @ matrices[i]
        state[d] = v / v.sum()
    for d, m, i in reversed(order):
        w = matrices[i] @ leave[place[d, m]]
        leave[place[d, m - 1]] = w / w.sum()
    return entry, leave


def expected_counts(model: Model, seq: np.ndarray, bounds: np.ndarray):
    """Baum-Welch sums over some documents: starts, moves, emissions, and the
    log likelihood relative to the unigram's."""
    begin, length, doc, number = _stretches(bounds)
    entry, leave = _edges(model, seq, begin, length, doc, number)
    k, types = model.states, len(model.unigram)
    ratio = (model.emit / model.unigram[:, None]).astype(np.float32)
    step, one = model.move.astype(np.float32), np.ones(k, np.float32)
    start, move, emit, log = np.zeros(k), np.zeros((k, k)), np.zeros((types, k)), 0.0
    tokens = np.cumsum(length)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(tokens, tokens[at] - length[at] + PIECE, side="right")))
        b, head = begin[at:to], number[at:to] == 0
        live = _active(length[at:to])
        out = leave[at:to].astype(np.float32)
        before = entry[at:to].astype(np.float32)
        alpha = np.where(head[:, None], before, before @ step)
        kinds, alphas, emits = [], [], []
        for t, n in enumerate(live):
            c = seq[b[:n] + t]
            e = ratio.take(c, axis=0)
            alpha = alpha[:n] @ step if t else alpha
            alpha *= e
            if t % SCALED == SCALED - 1:
                s = alpha @ one
                log += float(np.log(s).sum())
                s = (1 / s)[:, None]
                alpha *= s
                e *= s
            kinds.append(c)
            alphas.append(alpha)
            emits.append(e)
        gammas = []
        done = 0
        for t in range(len(live) - 1, -1, -1):
            n, alpha = live[t], alphas[t]
            beta = np.empty_like(alpha)
            if done:
                ahead = emits[t + 1]
                ahead *= later
                move += alpha[:done].T @ ahead
                np.matmul(ahead, step.T, out=beta[:done])
            if n > done:  # these end here
                w = out[done:n]
                log += float(np.log(alpha[done:] @ one).sum())
                beta[done:] = w / (alpha[done:] * w).sum(axis=1, keepdims=True)
            gammas.append(alpha * beta)
            later, done = beta, n
        start += gammas[-1][head].sum(axis=0)
        move += before[~head].T @ (emits[0] * later)[~head]
        c, gamma = np.concatenate(kinds[::-1]), np.ascontiguousarray(np.concatenate(gammas).T)
        rest = np.bincount(c, minlength=types).astype(np.float64)  # a token's weights add up to one
        for j in range(k - 1):
            part = np.bincount(c, weights=gamma[j], minlength=types)
            emit[:, j] += part
            rest -= part
        emit[:, k - 1] += np.maximum(rest, 0)
        at = to
    return start, move * model.move, emit, log


def log_likelihoods(model: Model, seq: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log likelihood of each document's classes, by the forward
    recursion over its stretches."""
    begin, length, doc, number = _stretches(bounds)
    out = np.zeros(len(bounds) - 1)
    first = np.flatnonzero(number == 0)
    log, end = _forward(model, seq, begin[first], length[first], np.tile(model.start, (len(first), 1)), 1)
    out[doc[first]] = log
    rest, matrices, scales = _transfers(model, seq, begin, length, number)
    state = np.zeros((len(out), model.states))
    state[doc[first]] = end
    for d, _, i in sorted(zip(doc[rest].tolist(), number[rest].tolist(), range(len(rest)), strict=True)):
        v = state[d] @ matrices[i]
        s = v.sum()
        state[d] = v / s
        out[d] += scales[i] + np.log(s)
    return out


def _expectation(shared):
    """The sums of a task, in blocks of rows: starts, likelihood, moves, emissions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = model.states
        total = np.zeros((2 + k + len(model.unigram), k))
        for batch in batches:
            kinds = batch.column("kinds")
            if len(kinds):
                offs = kinds.offsets.to_numpy().astype(np.int64)
                start, move, emit, log = expected_counts(model, kinds.flatten().to_numpy(), offs - offs[0])
                total[0] += start
                total[1, 0] += log
                total[2:2 + k] += move
                total[2 + k:] += emit
        parts = {at // BLOCK: total[at:at + BLOCK] for at in range(0, len(total), BLOCK)}
        parts = {n: x.astype(np.float32).tobytes() for n, x in parts.items() if x.any()}
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(list(parts.values()), pa.binary())],
                                         names=["block", "sums"])
    return run


def _added_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each block; a block's rows are in one partition."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for n, x in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
            x = np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
            total[n] = total[n] + x if n in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["block", "sums"])


def _round(model: Model, rows: DataFrame) -> None:
    """One Baum-Welch round over the class sequences of ``rows``."""
    k = model.states
    shared = rows.sparkSession.sparkContext.broadcast(model.parameters())
    blocks = arrow_map(rows.select("kinds"), _expectation(shared), "block int, sums binary").repartition("block")
    out = np.zeros((2 + k + len(model.unigram), k))
    for row in arrow_map(blocks, _added_blocks, "block int, sums binary").toLocalIterator():
        x = np.frombuffer(row.sums).reshape(-1, k)
        out[row.block * BLOCK:row.block * BLOCK + len(x)] = x
    shared.unpersist()
    model.history.append(out[1, 0])
    model.learn(out[0], out[2:2 + k], out[2 + k:])


def token_counts(training: DataFrame) -> DataFrame:
    """(token, c): the corpus counts of all training words, by hash."""
    return (arrow_map(training.select("text"), _count, "token long, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


def frequent_tokens(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent tokens, ``most`` at the utmost: those above a level
    of frequency (in steps of a sixteenth of a doubling), which a histogram of
    the levels tells without sorting the vocabulary."""
    level = F.floor(F.log2("c") * 16)
    cut, held = 0, 0
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            cut = row["level"] + 1
            break
    return counts.where(level >= cut)


def lexicon(training: DataFrame, counts: DataFrame, states: int = STATES, classes: int = CLASSES) -> Model:
    """Untrained model over the counts of the documents (doc_id, text) of ``training``."""
    ends = training.count()
    total = counts.agg(F.count("*").alias("types"), F.sum("c").alias("tokens")).first()
    top = frequent_tokens(counts, KNOWN).toArrow()
    return Model(top.column("token").to_numpy(), top.column("c").to_numpy(), (total.tokens or 0) + ends,
                 total.types + (1 if ends else 0), ends, states, classes)


_ENCODED = ("doc_id long, n_tokens long, known long, base double, rare_model long, rare_log double, kinds array<int>, "
            "rare array<long>, rare_times array<int>")


def _encoded(shared):
    """Classes of each document's tokens, and sums over the counts at hand;
    tokens whose count isn't go on with how often they occur.  ``rare_model``
    is how many of the model's rare tokens there are, ``rare_log`` the sum of
    the known ones' log counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, data, offs in A.chunks(batch):
                seq, bounds, tokens, first, kind, count = _sequences(model, data, offs)
                n = len(offs) - 1
                doc = np.repeat(np.arange(n), np.diff(first))
                here = count >= 0
                weight = np.where(here, np.log10(np.maximum(count, 0) + 1.0), 0.0)
                total = lambda x, doc=doc, n=n: np.bincount(doc, weights=x, minlength=n).astype(np.float64)
                rare = kind == model.n
                # The other tokens, each once per document.
                far = np.flatnonzero(~here)
                order = far[np.lexsort((tokens[far], doc[far]))]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (tokens[order][1:] != tokens[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                at = np.flatnonzero(new)
                cut = np.concatenate([[0], np.cumsum(np.bincount(doc[order][at], minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.diff(bounds)),
                     pa.array(total(here).astype(np.int64) + (1 if model.ends else 0)),
                     pa.array(total(weight) + np.log10(model.ends + 1.0)), pa.array(total(rare).astype(np.int64)),
                     pa.array(total(weight * rare)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(seq.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(tokens[order][at])),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(np.diff(np.append(at, len(order))).astype(np.int32)))],
                    names=["doc_id", "n_tokens", "known", "base", "rare_model", "rare_log", "kinds", "rare",
                           "rare_times"])
    return run


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """The documents' class sequences, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = keep(arrow_map(texts(docs), _encoded(shared), _ENCODED).withColumn("row", F.monotonically_increasing_id()),
                "encoded")
    shared.unpersist()
    return rows


def train(model: Model, rows: DataFrame, rounds: int = ROUNDS) -> None:
    """Baum-Welch over the class sequences ``kinds`` of ``rows``."""
    if not model.ends:
        return
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.select("kinds").coalesce(max(1, min(-(-model.tokens // PART), WAVES * cores)))
    for _ in range(rounds):
        _round(model, rows)
        # The likelihood is that before the round's learning: two of them make a gain.
        if len(model.history) > 1 and model.history[-1] - model.history[-2] < GAIN * model.tokens:
            break


def _likelihoods(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, at = batch.column("kinds"), 0
            offs = kinds.offsets.to_numpy().astype(np.int64)
            seq = kinds.flatten().to_numpy()
            offs = offs - offs[0] if len(offs) else offs
            while at < batch.num_rows:  # whole documents of about PIECE tokens
                to = max(at + 1, int(np.searchsorted(offs, offs[at] + PIECE, side="right")) - 1)
                log = log_likelihoods(shared.value, seq[offs[at]:offs[to]], offs[at:to + 1] - offs[at])
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, to - at) for c in batch.columns[:-1]), pa.array(log / np.log(10))],
                    names=[*batch.schema.names[:-1], "model"])
                at = to
    return run


def score(docs: DataFrame, parts: int = 7, left_out: int = 2, states: int = STATES, classes: int = CLASSES,
          rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row of ``docs``; scores are log10 probabilities of the text."""
    plain = texts(docs)
    learns = fold(F.col("doc_id"), parts) != left_out
    training = plain.where(learns)
    counts = keep(token_counts(training), "token_counts")
    model = lexicon(training, counts, states, classes)
    rows = encode(plain, model)
    train(model, rows.where(learns), rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model.parameters())
    scored = arrow_map(rows.select("row", "doc_id", "n_tokens", "known", "base", "rare_model", "rare_log", "kinds"),
                       _likelihoods(shared), "row long, doc_id long, n_tokens long, known long, base double, "
                       "rare_model long, rare_log double, model double")
    far = (rows.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x"))
           .select("row", F.col("x.rare").alias("token"), F.col("x.rare_times").alias("times")))
    found = (far.join(counts, "token").groupBy("row")
             .agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("log_c"), F.sum("times").alias("seen")))
    log_c, seen = F.coalesce("log_c", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    held_out = F.coalesce(fold(F.col("doc_id"), parts) == left_out, F.lit(False))
    return (scored.join(found, "row", "left")
            .select("doc_id", held_out.alias("held_out"), "n_tokens", (F.col("known") + seen).alias("n_known"),
                    F.lit(model.tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + log_c - F.col("n_tokens") * float(np.log10(model.all_mass))).alias("base_score"),
                    (F.col("model") + F.col("rare_log") + log_c
                     - F.col("rare_model") * float(np.log10(model.rare_mass))).alias("score")))
