"""Registered queries of the operators: each applies one to its whole table, with production parameters, and derives
the digest columns of its result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (alignment, bpe_codec, exact_dedup, fm_dedup, jaccard_join, line_dedup, packing, prefix_bpe, quality_rules, suffix_dedup, token_files,
               toxicity, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; ``LLM_TOKENIZERS`` names another folder that holds them."""
    if folder := os.environ.get("LLM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_codec.bpe_roundtrip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.posterior_quality(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op5_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=100).drop("kept")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), out, vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(spark, out)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", F.col("llm_n_lines").alias("n_lines"), F.col("llm_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64, shift=1_000_000)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.roundtrip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_fm_dedup": op5_fm_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_prefix_bpe": op13_prefix_bpe,
}
