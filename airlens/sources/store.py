"""Stored tables: published ones behind a commit log, private ones as Parquet folders in the shared work folder."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from airlens.session import fresh_path
from airlens.sources import manifest


def rebalanced(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows regrouped for writing with the REBALANCE hint.

    Hash-partitioned on ``by`` (the write's partition columns), then AQE splits
    a partition holding a large share of the rows (a hot day) into several
    tasks and merges small ones, so tasks write few, evenly sized files. No
    sampling pass over the input, and a retried task gets the same rows.
    """
    return df.hint("rebalance", *by)


def partition_days(spark: SparkSession, root: str) -> list[str]:
    """The days of a stored table, from its newest snapshot: no file is listed and no row read.

    An absent or empty table holds no day.
    """
    return manifest.snapshot(spark, root).day_list()


def save_days(df: DataFrame, path: str, days: Iterable[str] | None = None) -> DataFrame:
    """Make ``df`` the content of ``days`` (``None``: the whole table by day) in one job and one commit; read it back."""
    state = manifest.replace_days(rebalanced(df, ["date_ech"]), path, days)
    return manifest.read(df.sparkSession, path, df.schema, at=state)


def save_whole(df: DataFrame, path: str) -> DataFrame:
    """Make ``df`` the content of a table that is not kept by day; read it back."""
    state = manifest.replace_whole(df, path)
    return manifest.read(df.sparkSession, path, df.schema, at=state)


def open_table(spark: SparkSession, path: str, days: Iterable[str] | None = None) -> DataFrame:
    """A stored table with the columns of its files; an absent one is an error."""
    state = manifest.snapshot(spark, path)
    if not state.days:
        raise FileNotFoundError(f"no stored table in {path}")
    return spark.read.option("basePath", f"{state.root}/{manifest.DATA}").parquet(*state.folders(days)).drop(manifest.COMMIT)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                replace_partitions: bool = False) -> None:
    """Write ``df`` as Parquet (snappy); a table partitioned by day is rebalanced on it
    first, an unpartitioned one (an aggregate) is written as its tasks produce it.

    An overwrite replaces the whole table, or with ``replace_partitions`` only
    the partitions present in ``df`` (dynamic partition overwrite).
    """
    out = rebalanced(df, partition_by) if partition_by else df
    writer = (out.write.mode(mode).option("compression", "snappy")
              .option("partitionOverwriteMode", "dynamic" if replace_partitions else "static"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a stored table back with the schema and column order of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and return the stored table.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    inputs) and lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    write_table(df, path, partition_by)
    return read_table(spark, path, df)
