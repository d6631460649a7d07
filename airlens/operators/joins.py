"""Joins against reference tables, with the broadcast behind a check of its bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side is broadcast if its estimate, times this allowance for compression, ...
EXPANSION = 8
#: ... stays within these bytes. Beyond, the join shuffles, and AQE splits skewed partitions.
BROADCAST_MAX_BYTES = 128 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (of the files read, for a scan); planning only, no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_small(fact: DataFrame, dim: DataFrame, on, how: str = "left",
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``fact.join(dim)``, broadcasting ``dim`` if its estimated bytes allow it; the rows are the same either way."""
    if EXPANSION * estimated_bytes(dim) <= max_bytes:
        return fact.join(F.broadcast(dim), on, how)
    return fact.join(dim, on, how)
