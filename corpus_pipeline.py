"""The corpus pipeline: five stages over `documents`, each stored before the next one reads it.

Quality rules take rejected documents out; line dedup takes recurring boilerplate lines out of the
texts (and documents of nothing else); near-duplicate removal keeps the smallest id of each group;
mixing draws the documents that bring sources, languages and topics to their target
weights; byte-level BPE turns the rest into token ids. All but the last keep the columns of
`documents`.

Cases: an empty table passes through as one; a null text counts as empty and is rejected by the first stage, as are
documents of few words; very long texts are read whole in every stage; repeated rows go alike through the first two stages
and the third keeps the rows of the smallest id (all rows that repeat it); rows without an id are nobody's copy; of equal
draws all are drawn; extra columns are kept, whatever their names, and `n_chars` is counted anew where there is one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens.llm import bpe, line_templates, minmax_dedup, mixing, quality_bands
from airlens.llm.common import read_table, written
from airlens.llm.registry import RANK_FILE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_bands.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without boilerplate lines; a document that consisted of nothing else goes."""
    left = line_templates.drop_boilerplate(docs).where("length(trim(text)) > 0")
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax_dedup.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_report(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("encode", encode),
]

#: zstandard ratios, template trees and min-max hashing have no SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
