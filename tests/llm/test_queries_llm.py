"""Registered queries against their SQL twins, and the pipeline's stages."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline as P
from corpus import documents, empty, frame, words
from tallyspark.llm import quality
from tallyspark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in cols) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == want


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with labels and a benchmark for the awkward corpus."""
    rows, folder = documents(), str(tmp_path_factory.mktemp("small"))
    labels = [(i, int(i % 3 > 0), 0) for i, _, _ in rows if i is not None and i < 60]
    items = [(1, " ".join(rows[4][1].split()[3:20])), (2, rows[30][1].upper()), (3, "words in all")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_stages_against_brute_force(spark, small):
    """Each stage on all that the one before kept: its decisions take effect,
    and what it does not decide on stays."""
    from test_dedup import plain_components, plain_lines
    from test_mix_search import plain_hits, plain_mix
    from test_models import plain_vote
    folder, items = small
    assert [n for n, _ in P.STAGES] == ["quality_filter", "line_dedup", "minhash_near_dedup", "decontaminate",
                                        "mix_sources"]
    rows = list({r[0]: r for r in documents()}.values())
    rows += [[300 + k, f"{rows[k][1]}\nThe same line under each of them.", "src1"] for k in (1, 2, 4, 5, 7)]
    docs = frame(spark, rows)
    plain = lambda df: sorted(([r.doc_id, r.text, r.source] for r in df.collect()), key=str)
    for name, stage in P.STAGES:
        rows, out = plain(docs), P.keep(stage(spark, docs, folder), name)
        if name == "quality_filter":
            model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            want = [r for r in rows if plain_vote(model, r[1]) >= 0.7]
        elif name == "line_dedup":
            cut = plain_lines(rows, 2)
            left = [[i, t and "\n".join(x for p, x in enumerate(cut[i is None, i or 0, t][0])
                                        if p not in cut[i is None, i or 0, t][1]), s] for i, t, s in rows]
            want = [b for a, b in zip(rows, left, strict=True) if a == b or words(b[1])]
        elif name == "minhash_near_dedup":
            want = [r for r, (*_, kept) in zip(rows, plain_components(rows), strict=True) if kept or r[0] is None]
        elif name == "decontaminate":
            want = [r for r, (_, _, hit, _) in zip(rows, plain_hits(rows, items), strict=True) if not hit]
        else:
            got = sorted(((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken)
                          for r in out.collect()), key=str)
            assert got == sorted((r for r in plain_mix(rows) if r[-1]), key=str)
            assert out.columns == [*(c for c in docs.columns if c != "size"), "size", "source_size", "target", "taken"]
            break
        assert plain(out) == sorted(want, key=str) and want and sorted(want, key=str) != rows, name
        assert out.columns == docs.columns
        docs = out


def test_columns_of_any_name(spark, small):
    names = ["doc_id", "text", "source", "__copy", "copy", "__doc", "doc", "row", "whole", "key", "carried", "r0"]
    rows = [[r[0], r[1], r[2], *range(9)] for r in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(
        f"{n} long" for n in names[3:]))
    for name, stage in P.STAGES:
        out = stage(spark, docs, small[0])
        assert out.columns[:len(names)] == names, name
        assert {tuple(r[n] for n in names[3:]) for r in out.collect()} == {tuple(range(9))}


@pytest.mark.parametrize("number", range(5))
def test_stages_on_awkward_rows(spark, number):
    _, stage = P.STAGES[number]
    rows = [r for r in documents() if r[0] != 137]
    out = stage(spark, frame(spark, rows), SF)
    assert 0 < out.count() <= len(rows)
    if number < 4:
        assert out.columns == frame(spark, rows).columns
        assert out.where("doc_id is null").count() > 0
    assert stage(spark, empty(spark), SF).count() == 0
