"""Registered queries of this folder: one per operator, over whole tables.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds the
DuckDB twin where SQL can express the operator.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import ann, bpe, crosstok, hmm, lineruns, minhash, mixing, periods, pivots, quality, suffixes, toxicity, wumanber
from tallyspark.llm.frames import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its nearest labelled documents."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents inside repeated strings of 200 bytes."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of benchmark items in all documents."""
    found = wumanber.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log likelihood of every document under the hidden Markov model."""
    return hmm.score(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated line runs removed from all documents."""
    cut = lineruns.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its significant passages."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("passages")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under the 32,000-piece vocabulary."""
    return bpe.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies linked by the bytes they cover, in every text."""
    return crosstok.cross_align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text."""
    return periods.periodic_runs(table(spark, sf_dir, "documents"))


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest integer inner products of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return pivots.top_products(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_mixing": op2_mixing,
    "op3_nearest_vectors": op3_nearest_vectors,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_hmm_scores": op7_hmm_scores,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_cross_tokens": op11_cross_tokens,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_top_products": op13_top_products,
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op6_decontamination": wumanber.ORACLE,
    "op8_line_dedup": lineruns.ORACLE,
    "op13_top_products": pivots.ORACLE,
}
