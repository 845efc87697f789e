"""Texts of over a megabyte, each a chunk of its own, through every operator
and the pipeline."""

from __future__ import annotations

import random

import corpus_pipeline as P
import public_tokenizers
import pytest
from corpus import documents, frame, prose, words

from tallyspark.llm import bpe, crosstok, hmm, lineruns, minhash, mixing, periods, quality, suffixes, toxicity, wumanber

PASSAGE = "seven words that no other text here has"


@pytest.fixture(scope="module")
def rows():
    long = prose(random.Random(3), 200_000)
    assert len(long) > 1 << 20
    return [[1, long, "a"], [2, long + " " + PASSAGE, "b"], *documents()[5:15]]


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(i, k % 2, k % 2) for k, (i, *_) in enumerate(rows)],
                                 "doc_id long, quality int, toxic int")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_sets_lines_and_strings(spark, rows):
    docs = frame(spark, rows)
    near = by_id(minhash.near_duplicates(docs))
    assert near[2].component_id == 1 and near[1].kept and not near[2].kept
    assert near[1].n_shingles == len({tuple(w) for w in zip(*(words(rows[0][1])[k:] for k in range(5)))})
    cut = by_id(lineruns.dedup_lines(docs))
    assert cut[1].n_removed == 0 and cut[2].n_removed == rows[0][1].count("\n") and PASSAGE in cut[2].kept_text
    gone = by_id(suffixes.remove_repeats(docs, digest=True))
    assert gone[1].n_removed == gone[1].n_bytes == len(rows[0][1].encode())
    assert gone[2].n_bytes - gone[2].n_removed <= len(PASSAGE) + 1


def test_searches_and_counts(spark, rows):
    docs = frame(spark, rows)
    items = spark.createDataFrame([(9, PASSAGE)], "item_id long, text string")
    hits = by_id(wumanber.find_items(docs, items))
    assert (hits[1].n_hit, hits[2].n_hit, list(hits[2]["items"])) == (0, 8, ["9"])
    assert by_id(mixing.mix(docs))[1].size == 200_000
    a, b = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    counts = by_id(bpe.token_counts(docs, b))
    pairs = by_id(crosstok.cross_align(docs, a, b))
    assert counts[1].n_tokens == pairs[1].n_b > 200_000 and counts[1].over_limit
    assert by_id(periods.periodic_runs(docs))[1].n_runs is not None


def test_models(spark, rows, labels):
    docs = frame(spark, rows)
    for module in (quality, toxicity):
        assert all(0 <= r.score <= 1 for r in module.score(docs, labels).collect())
    scores = by_id(hmm.score(docs, states=2, rounds=1))
    assert scores[1].n_tokens == 200_001 and scores[2].score < scores[1].score < 0


def test_pipeline(spark, rows, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(9, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() >= 0
