"""Cleaning a training corpus, stage by stage.

``STAGES`` lists (name, function); each function takes the documents that
the stage before kept and returns the documents it keeps.  ``run`` applies
them to ``documents``: every stage's result is written as Parquet under the
shared folder and read back as the next one's input.

All stages take an empty table, null, empty and very long texts, repeated
rows and ids, and further columns of any names, which travel unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import lineruns, minhash, mixing, quality, wumanber
from tallyspark.llm.frames import WORD, keep, table


def _packed(docs: DataFrame, *left_out: str) -> Column:
    """The columns of a document as one, so their names meet no others."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in left_out]).alias("__doc")


def _unpacked(docs: DataFrame, text: str = "text") -> list[Column]:
    return [F.col(text).alias("text") if c == "text" else F.col(f"__doc.`{c}`") for c in docs.columns]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for low quality go.  Null and empty
    texts score the share of good documents in the labelled sample; rows of
    one id are judged each by its own text."""
    scored = quality.score(docs.select(_packed(docs, "text"), "doc_id", "text"), table(spark, sf_dir, "labels"),
                           rest=("__doc", "text"))
    return scored.where("predicted = 1").select(*_unpacked(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go.  A document that had words and
    is left without any goes as a whole; all others stay, among them null and
    empty texts.  Rows of one id and equal text are cut alike."""
    cut = lineruns.dedup_lines(docs.select(_packed(docs), "doc_id", "text"))
    left = cut.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(WORD))
    return left.select(*_unpacked(docs, "kept_text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the smallest
    id.  Documents without an id or without words are in no class and stay;
    rows that share an id stay or go together."""
    copies = (minhash.near_duplicates(docs.select("doc_id", "text")).where("not kept and doc_id is not null")
              .select(F.col("doc_id").alias("__copy")))
    whole = docs.select(_packed(docs), F.col("doc_id").cast("long").alias("__id"))
    return (whole.join(copies, F.col("__id") == F.col("__copy"), "left_anti")
            .select(*[F.col(f"__doc.`{c}`") for c in docs.columns]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words inside a passage of the benchmark go.  Null and
    empty texts have none; without benchmark items all stay."""
    rest = docs.select(_packed(docs, "text"), "doc_id", "text")
    return wumanber.clean_documents(rest, table(spark, sf_dir, "benchmark"), "__doc").select(*_unpacked(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with size, source_size, target and taken (in
    place of columns so named): the words the mix takes of the document,
    repeats counted.  Documents without words take no part."""
    return mixing.mix(docs, keep_columns=True).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: The learned and set-similarity stages have no SQL twin; tests/llm holds
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
