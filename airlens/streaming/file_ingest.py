"""Exactly-once file ingest with Structured Streaming.

Raw day files land in a folder; a file stream with ``availableNow`` processes
every file not seen before and stops. The checkpoint (in the shared folder)
records the files already taken, so a re-run takes nothing twice. The store is the batch ingest's:
a micro-batch adds its files beside those that its days already hold and publishes them by one commit, named
after the stream and the batch. A batch retried after a failure finds its commit in the log, or writes the same
files again; files of earlier batches are never touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.sources.ingest import is_day
from airlens.sources.manifest import append_days
from airlens.sources.schemas import RAW_AIR
from airlens.sources.store import rebalanced


def stream_ingest(spark: SparkSession, landing: str, store_root: str, checkpoint: str,
                  schema=RAW_AIR, file_format: str = "parquet", max_files_per_trigger: int | None = None) -> int:
    """Move every new landed file into the day-partitioned store; returns the number of batches that stored rows."""
    src = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger is not None:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format == "csv":
        src = src.option("header", True)
    stream = src.load(landing)

    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the id that the checkpoint gave the stream: a stream that begins anew has another one
        name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = batch.withColumn("date_ech", F.col("date_ech").cast("string")).where(is_day(F.col("date_ech")))
        if append_days(rebalanced(rows, ["date_ech"]), store_root, f"{name}-{batch_id:012d}"):
            batches.append(batch_id)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return len(batches)
