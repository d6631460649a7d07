"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the engine wants. Shuffle width is left to AQE: it
# coalesces small partitions at run time and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no broadcast from file-size estimates (compressed sizes can hide large
    # tables); AQE still broadcasts a side whose measured shuffle output is small,
    # and the engine's own broadcasts sit behind a row-count check
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "airlens", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the engine defaults (tests, bench, CLI)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # ensure the documented timezone even when a session already existed
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Cluster profile: an initial shuffle width for the largest shuffle (a year of
# readings or a large backfill); AQE coalesces to ~128 MB partitions, so small
# shuffles do not pay for the width, and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}


def cluster_session(app_name: str = "airlens", extra: dict | None = None) -> SparkSession:
    """Session for spark-submit on a cluster (master and resources come from the submit).

    ``spark.checkpoint.dir`` must name a shared folder (see :func:`shared_dir`).
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULT_CONF, **CLUSTER_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    On a cluster it must be set (a shared file system or object store); only a
    local session without it gets a private folder, as in tests. The setting is
    read, never changed; a folder made here is registered as the context's
    checkpoint folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="airlens-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used folder under the shared work folder."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "airlens", f"{name}-{uuid.uuid4().hex}")
