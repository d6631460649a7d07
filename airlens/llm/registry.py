"""Registered queries of the corpus operators and their DuckDB SQL (where SQL can say the same)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, chat_format, collocations, line_templates, minmax_dedup, mixing, pii_bootstrap, pivot_links, quality_bands,
    topk_blocks, toxicity, turn_repair, url_cascade,
)
from .common import read_table

URL_RULES = (
    url_cascade.Rule("allow", "com", "/"),
    url_cascade.Rule("block", "example.com", "/en/"),
    url_cascade.Rule("allow", "www.example.com", "/en/"),
    url_cascade.Rule("block", "net", "/es/"),
    url_cascade.Rule("block", "net", "/fr/"),
)
RANK_FILE = "byte_bpe_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.personal_data(read_table(spark, sf_dir, "documents"))


def op4_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_blocks.top_scores(read_table(spark, sf_dir, "embeddings"))


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE),
                            public_tokenizers.PATTERN)


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_report(read_table(spark, sf_dir, "conversations"))


def op9_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.quality_report(read_table(spark, sf_dir, "documents"))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.line_report(read_table(spark, sf_dir, "documents"))


def op11_pivot_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_links.linked_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(read_table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_pii_bootstrap": op3_pii_bootstrap,
    "op4_topk_blocks": op4_topk_blocks,
    "op5_url_cascade": op5_url_cascade,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_minmax_dedup": op7_minmax_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_quality_bands": op9_quality_bands,
    "op10_line_templates": op10_line_templates,
    "op11_pivot_links": op11_pivot_links,
    "op12_turn_repair": op12_turn_repair,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op2_mixing": mixing.oracle_sql(),
    "op4_topk_blocks": topk_blocks.ORACLE_SQL,
    "op5_url_cascade": url_cascade.ORACLE_SQL,
    "op8_chat_format": chat_format.ORACLE_SQL,
    "op11_pivot_links": pivot_links.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
