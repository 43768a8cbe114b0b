"""The operators' registered queries, over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from pathwise.llm import byte_bpe as op11
from pathwise.llm import decontaminate as op8
from pathwise.llm import exact_dedup as op1
from pathwise.llm import html_wrapper as op7
from pathwise.llm import jaccard_join as op5
from pathwise.llm import language_id as op2
from pathwise.llm import lexical_search as op12
from pathwise.llm import line_dedup as op10
from pathwise.llm import packing as op3
from pathwise.llm import secret_scan as op9
from pathwise.llm import substring_dedup as op6
from pathwise.llm import warc as op4
from pathwise.llm import whitening as op13
from pathwise.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.exact_dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.identify_corpus(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.round_trip(table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.jaccard_groups(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.extract_main_text(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.secret_digest(op9.scan_secrets(table(spark, sf_dir, "documents")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.dedup_lines(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.token_digests(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_decontamination": op8_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_lexical_search": op12_lexical_search,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": op1.ORACLE, "op12_lexical_search": op12.ORACLE}
