"""A training corpus from ``documents``: language, copies, near copies,
benchmark passages, packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; ``run`` writes each stage's rows as Parquet in the shared folder and
reads them again, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pathwise.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from pathwise.llm.common import stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the smallest id."""
    return jaccard_join.drop_near_copies(docs, k=5, num=80, den=100)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: SQL expresses neither the language model nor the tokenizer; tests/llm
#: compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
