"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pkgsync.llm import exact_dedup, jaccard_join, packing, quality_rules, suffix_dedup
from pkgsync.llm.queries import vocabulary
from pkgsync.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no base rule fails and whose posterior quality probability is at least one half."""
    return quality_rules.drop_low_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest, then the smallest id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles at 0.8 or more."""
    return jaccard_join.drop_near_duplicates(docs, size=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without bytes of 100-byte strings that stand earlier."""
    return suffix_dedup.drop_repeats(docs, width=100)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences of at most 2048 ids."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("suffix_array_dedup", substrings),
    ("best_fit_packing", pack),
]

#: The label model and the packing can't be written in SQL; tests hold the operators, stage by stage, against brute force or labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
