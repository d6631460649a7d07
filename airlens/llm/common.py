"""Helpers the corpus operators share: table access, scratch tables, safe column names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of anything but space, tab, LF, VT, FF and CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (set to a private one only where unset, as in tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores added until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def whole(text: str | Column) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def groups(texts: list[str], chars: int = 1 << 21) -> Iterator[list[str]]:
    """Consecutive texts, together about ``chars`` long (a longer one alone)."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > chars:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def roughly_in(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, buckets: int = 1 << 19) -> DataFrame:
    """Rows of ``df`` whose key's bucket holds a wanted key: all wanted rows and a few others.

    What is broadcast has at most ``buckets`` integers, however many keys are wanted; an exact join
    that follows then shuffles little. Null keys are never wanted.
    """
    name = free_name(df, "bucket")
    bucket = lambda k: F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int").alias(name)
    few = wanted.where(wanted_key.isNotNull()).select(bucket(wanted_key)).distinct()
    return df.withColumn(name, bucket(key)).join(F.broadcast(few), name, "left_semi").drop(name)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, ..., start + size - 1 of each range, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
