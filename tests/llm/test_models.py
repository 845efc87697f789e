"""The learned operators: held-out accuracy, exact likelihoods, awkward rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import numpy as np
import pytest
from corpus import documents, empty, fold, frame, words

from tallyspark.llm import hmm, quality, toxicity

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
NO_LABELS = "doc_id long, quality int, toxic int"


@needs_tables
@pytest.mark.parametrize("module, label, accuracy", [(quality, "quality", 0.95), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, module, label, accuracy):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = module.score(docs, labels)
    rows = out.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", label).collect()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r[label] for r in held) / len(held) >= accuracy
    assert out.count() == docs.count()


def _labels(spark, rows):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i, _, _ in rows if i is not None and i < 40]
                                 + [(7, None, None), (9999, 1, 1), (None, 1, 1)], NO_LABELS)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows_are_scored(spark, module):
    rows = documents()
    got = module.score(frame(spark, rows), _labels(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    again = module.score(frame(spark, rows), _labels(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((str(r.doc_id), r.score) for r in again)
    none = spark.createDataFrame([], NO_LABELS)
    assert len({r.score for r in module.score(frame(spark, rows), none).collect()}) == 1
    assert module.score(empty(spark), none).count() == 0


def test_labels_left_out_do_not_matter(spark):
    rows = documents()
    labels = _labels(spark, rows)
    held = [i for i in range(40) if fold(i, 4) == 2]
    flipped = labels.where(~labels.doc_id.isin(held)).union(
        spark.createDataFrame([(i, 1 - i % 2, 1) for i in held], NO_LABELS))
    for module in (quality, toxicity):
        a, b = (sorted((str(r.doc_id), r.score) for r in module.score(frame(spark, rows), x).collect())
                for x in (labels, flipped))
        assert a == b


@needs_tables
@pytest.mark.parametrize("module", [quality, toxicity])
def test_equal_texts_score_alike(spark, module):
    """Over the whole table, labelled or not."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = module.score(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {}
    for r in out.join(docs, "doc_id").select("text", "score").collect():
        scores.setdefault(r.text, []).append(r.score)
    assert sum(len(v) > 1 for v in scores.values()) > 20
    assert all(max(v) - min(v) < 1e-6 for v in scores.values())


def plain_vote(model, text):
    """Features counted one by one, all cosines, all neighbours sorted."""
    def vector(text):
        data = np.frombuffer(text.encode(), np.uint8)
        _, feature = quality.features(data, np.array([0, len(data)]))
        v = np.zeros(quality.DIMS)
        for f, n in Counter(feature.tolist()).items():
            v[f] = math.log1p(n) * model["idf"][f]
        v = v @ model["space"]
        return v / max(np.linalg.norm(v), 1e-12)

    if not words(text):
        return model["prior"]
    cos = sorted(((float(vector(text) @ p), y) for p, y in zip(model["points"], model["labels"], strict=True)),
                 reverse=True)[:quality.NEIGHBOURS]
    w = [max(c, 1e-6) ** quality.SHARPNESS for c, _ in cos]
    return sum(a * y for a, (_, y) in zip(w, cos, strict=True)) / sum(w)


def test_vote_against_plain_vote(spark):
    """Features counted word by word, all cosines, all neighbours sorted."""
    rows = documents()
    docs, labels = frame(spark, rows), _labels(spark, rows)
    model = quality.fit(docs, labels)
    got = {(r.doc_id, r.text): r.score for r in quality.score(docs, labels, rest=("text",)).collect()}
    known = {i: i % 2 for i in range(40) if fold(i, 4) != 2}
    texts_of = {}
    for i, t, _ in rows:
        if i in known:
            texts_of.setdefault(i, set()).add(t)

    assert len(model["points"]) == len(known) - sum(t == {None} for t in texts_of.values())
    for (i, text), score in got.items():
        assert abs(score - plain_vote(model, text)) < 1e-3


def test_one_id_for_a_third_of_all_rows(spark):
    """The sample holds one text of it and one row of its repeated label."""
    rows = [[3, f"text number {k} of one id", "s"] for k in range(40)] + documents()
    labels = _labels(spark, documents()).union(spark.createDataFrame([(3, 1, 0)] * 50, NO_LABELS))
    sample = quality.labelled_sample(frame(spark, rows), labels, "quality", 100).collect()
    assert len(sample) == len({(r.doc_id, r.label) for r in sample})
    assert sum(r.doc_id == 3 for r in sample) == 1


def test_toxicity_against_plain_scores(spark):
    """K, evidence, curve and scores, document by document; every segment counts."""
    rows = list({i: [i, t, s] for i, t, s in documents()}.values())
    vile = "gorch blaft snurk"
    rows = [[i, t if t is None else t + (f" {vile} and " * 12 if i is not None and i < 40 and i % 5 == 0 else ""), s]
            for i, t, s in rows]
    docs, labels = frame(spark, rows), _labels(spark, rows)
    model = toxicity.fit(docs, labels)
    scores, law = model["scores"].value, model["law"]

    def segments(text, own=None):
        data = np.frombuffer(text.encode(), np.uint8)
        *places, first = toxicity.slots(data, np.array([0, len(data)]))
        token = scores(places, None if own is None else np.full(first[-1], own, np.float32))
        return [s for *_, s in toxicity.maximal_segments(token)], len(token), token

    one = {r.doc_id: (r.text, r.label) for r in quality.labelled_sample(docs, labels, "toxic", 1 << 16).collect()}
    held = np.zeros(toxicity.BINS)
    for _, t, _ in rows:
        for x in segments(t or "")[2]:
            held[int((x - toxicity.LOW) / (toxicity.HIGH - toxicity.LOW) * (toxicity.BINS - 1))] += 1
    assert math.isclose(law.rate, toxicity.decay(held), rel_tol=1e-3)
    found = {i: (*segments(t or "", y)[:2], y) for i, (t, y) in one.items()}
    tops = [law.rate * max(s) - math.log(n) for s, n, y in found.values() if s and not y]
    assert math.isclose(law.log_k, np.median(tops) + math.log(math.log(2)), rel_tol=1e-4)

    def evidence(s, n):
        z = [law.rate * x - law.log_k - math.log(max(n, 1)) for x in s]
        good = [x for x in z if x > 0]
        return [max(z, default=-10), math.log1p(sum(good)), math.log1p(len(good)), 1.0]

    x = np.array([evidence(s, n) for s, n, _ in found.values()])
    y = np.array([y for *_, y in found.values()], float)
    gradient = x.T @ (y - 1 / (1 + np.exp(-x @ model["curve"]))) - 1e-2 * model["curve"]
    assert np.abs(gradient).max() < 1e-2
    assert max(len([v for v in s if law.rate * v - law.log_k - math.log(n) > 0]) for s, n, _ in found.values()) > 0
    for r in toxicity.score(docs, labels).collect():
        s, n, _ = segments(next(t for i, t, _ in rows if i == r.doc_id) or "")
        assert abs(r.score - 1 / (1 + math.exp(-float(np.dot(model["curve"], evidence(s, n)))))) < 1e-4


def test_maximal_segments_against_all_segments():
    """Each segment found is maximal: by the definition, recursively."""
    rng = np.random.default_rng(4)

    def plain(s, lo, hi):
        best = max(((s[a:b].sum(), -a, -b, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)),
                   default=(0, 0, 0, 0, 0), key=lambda x: (round(x[0], 9), -(x[4] - x[3])))
        if best[0] <= 0:
            return []
        return plain(s, lo, best[3]) + [(best[3], best[4])] + plain(s, best[4], hi)

    for _ in range(60):
        s = np.round(rng.normal(-0.3, 1.0, 14), 3)
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(s)] == plain(s, 0, len(s))


def test_decay_solves_its_equation():
    held = np.zeros(toxicity.BINS)
    held[[100, 400]] = [90, 10]
    rate = toxicity.decay(held)
    value = toxicity.LOW + np.arange(toxicity.BINS) / (toxicity.BINS - 1) * (toxicity.HIGH - toxicity.LOW)
    assert math.isclose((held / 100 * np.exp(rate * value)).sum(), 1.0, abs_tol=1e-6)


def _model(states=3, classes=6, seed=0):
    rng = np.random.default_rng(seed)
    m = hmm.Model(np.arange(classes), np.arange(classes)[::-1] + 3, 99, classes + 1, 4, states, classes)
    m.start = rng.dirichlet(np.ones(states))
    m.move = rng.dirichlet(np.ones(states), states)
    m.emit = rng.dirichlet(np.ones(classes + 2), states).T.copy()
    return m


def _forward(m, seq):
    a = m.start * m.emit[seq[0]]
    for c in seq[1:]:
        a = (a @ m.move) * m.emit[c]
    return a


def test_likelihood_is_exact_over_stretches(monkeypatch):
    m = _model()
    rng = np.random.default_rng(1)
    sizes = [1, 2, 5, 17, 40, 3]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    seq = rng.integers(0, 8, bounds[-1])
    want = [math.log(_forward(m, seq[a:b]).sum()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for stretch in (64, 7, 1):
        monkeypatch.setattr(hmm, "STRETCH", stretch)
        assert np.allclose(hmm.log_likelihoods(m, seq, bounds), want)


def test_expected_counts_against_all_paths(monkeypatch):
    import itertools
    m = _model(2, 3)
    seq, bounds = np.array([0, 3, 1, 4, 2, 2, 4]), np.array([0, 4, 7])
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((5, 2))
    for a, b in ((0, 4), (4, 7)):
        s = seq[a:b]
        total = _forward(m, s).sum()
        for path in itertools.product(range(2), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= m.move[path[t - 1], path[t]] * m.emit[s[t], path[t]]
            p /= total
            start[path[0]] += p
            for t, c in enumerate(s):
                emit[c, path[t]] += p
                if t:
                    move[path[t - 1], path[t]] += p
    want = sum(math.log(_forward(m, seq[a:b]).sum()) - np.log(m.unigram[seq[a:b]]).sum() for a, b in ((0, 4), (4, 7)))
    for stretch, piece in ((64, 100), (2, 100), (1, 3), (3, 1)):  # nothing is lost at a border
        monkeypatch.setattr(hmm, "STRETCH", stretch)
        monkeypatch.setattr(hmm, "PIECE", piece)
        got = hmm.expected_counts(m, seq, bounds)
        for x, y in zip(got, (start, move, emit, want), strict=True):
            assert np.allclose(x, y, rtol=1e-5, atol=1e-5)


@pytest.mark.parametrize("known", [1 << 18, 60])
def test_language_model(spark, monkeypatch, known):
    monkeypatch.setattr(hmm, "KNOWN", known)
    rows = documents()
    got = hmm.score(frame(spark, rows), states=3, classes=20, rounds=1).collect()
    counts = Counter()
    for i, t, _ in rows:
        if i is not None and fold(i, 7) != 2:
            counts.update(words(t))
            counts["\n"] += 1  # the end; never a word
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, _ in rows:
        w = [*words(t), "\n"]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[i, i is not None and fold(i, 7) == 2, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in got) == want
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_every_round_sees_all_documents_and_types(spark, monkeypatch):
    """2,100 documents of 20 words of their own, three times each."""
    seen = []
    def note(model, rows):
        seen.append(rows.count())
        model.history.append(len(seen) * 1e9)
    monkeypatch.setattr(hmm, "_round", note)
    docs = spark.range(2100).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(id * 60, id * 60 + 59), x -> concat('w', x div 3))) AS text")
    model = hmm.lexicon(docs, hmm.token_counts(docs))
    hmm.train(model, hmm.encode(docs, model))
    assert set(seen) == {2100} and len(seen) == hmm.ROUNDS
    assert model.n == 42000


def _plain_training(rows, states, classes, rounds):
    """Baum-Welch without stretches, scaling or sharing, in the model's own start."""
    docs = [[*words(t), "\n"] for i, t, _ in rows if i is not None and fold(i, 7) != 2]
    counts = Counter(x for d in docs for x in d if x != "\n")
    hashes = {}
    for w in counts:
        data = np.frombuffer(w.encode(), np.uint8)
        hashes[w] = int(hmm.token_hashes(data, np.array([0, len(data)]))[0][0])
    ordered = sorted(counts, key=lambda w: (-counts[w], hashes[w]))
    m = hmm.Model(np.array([hashes[w] for w in ordered]), np.array([counts[w] for w in ordered]),
                  sum(map(len, docs)), len(counts) + 1, len(docs), states, classes)
    top = {w: k for k, w in enumerate(ordered[:m.n])}
    place = lambda w: m.n + 1 if w == "\n" else top.get(w, m.n)
    log = lambda seq: sum(math.log(x) for x in _scaled(m, seq)[1])
    for _ in range(rounds):
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(m.emit)
        for d in docs:
            seq = [place(w) for w in d]
            alphas, scales = _scaled(m, seq)
            beta = np.ones(states)
            for t in range(len(seq) - 1, -1, -1):
                emit[seq[t]] += alphas[t] * beta
                if t:
                    ahead = m.emit[seq[t]] * beta / scales[t]
                    move += alphas[t - 1][:, None] * m.move * ahead[None]
                    beta = m.move @ ahead
            start += alphas[0] * beta
        m.learn(start, move, emit)
    out = Counter()
    for i, t, _ in rows:
        w = [*words(t), "\n"]
        extra = sum(math.log10((counts[x] + 1) / m.rare_mass) for x in w if place(x) == m.n)
        out[i, round(log([place(x) for x in w]) / math.log(10) + extra, 1)] += 1
    return out


def _scaled(m, seq):
    a, alphas, scales = None, [], []
    for c in seq:
        a = (m.start if a is None else a @ m.move) * m.emit[c]
        scales.append(a.sum())
        a = a / scales[-1]
        alphas.append(a)
    return alphas, scales


def test_scores_equal_plain_training(spark, monkeypatch):
    monkeypatch.setattr(hmm, "STRETCH", 50)
    monkeypatch.setattr(hmm, "GAIN", -1e9)
    rows = documents()
    got = hmm.score(frame(spark, rows), states=3, classes=40, rounds=4).collect()
    assert Counter((r.doc_id, round(r.score, 1)) for r in got) == _plain_training(rows, 3, 40, 4)


def test_likelihood_rises_until_it_stops(spark):
    from tallyspark.llm.frames import texts
    docs = texts(frame(spark, documents()))
    model = hmm.lexicon(docs, hmm.token_counts(docs), 3, 200)
    hmm.train(model, hmm.encode(docs, model), 40)
    h = model.history
    assert 2 < len(h) < 40 and all(b > a for a, b in zip(h, h[1:], strict=False))


def test_words_find_their_places():
    rng = np.random.default_rng(3)
    known = np.unique(rng.integers(-1 << 62, 1 << 62, 5000))
    known = np.append(known, known[:50] + (1 << 40))  # these meet in their slots
    counts = rng.integers(1, 99, len(known))
    counts += 2
    m = hmm.Model(known, counts, 10 ** 6, 9000, 4, 2, 3000)
    other = rng.integers(-1 << 62, 1 << 62, 500)
    kind, count = m.place(np.concatenate([known, other]))
    assert np.array_equal(count, np.append(counts, np.full(500, -1)))
    order = np.lexsort((known, -counts))
    rank = np.empty(len(known), int)
    rank[order] = np.arange(len(known))
    assert np.array_equal(kind, np.append(np.minimum(rank, 3000), np.full(500, 3000)))


def test_probabilities_add_up():
    """Emissions, moves and the share of rare tokens are distributions."""
    m = _model()
    assert math.isclose(m.unigram.sum(), 1.0)
    m.learn(np.ones(3), np.ones((3, 3)), np.random.default_rng(2).random((8, 3)))
    assert np.allclose(m.emit.sum(axis=0), 1) and np.allclose(m.move.sum(axis=1), 1)
    assert math.isclose(m.all_mass, (m.counts + 1).sum() + m.ends + 1 + m.rare_mass)


def test_language_model_without_training_rows(spark):
    left_out = next(i for i in range(100) if fold(i, 7) == 2)
    got = hmm.score(frame(spark, [[left_out, "some words", "s"], [None, None, "s"]])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert hmm.score(empty(spark)).count() == 0
