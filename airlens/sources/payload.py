"""Weather service responses: per-location arrays flattened to (location, day) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.operators.joins import join_small
from airlens.sources.schemas import WEATHER_MEASURES

SECONDS_PER_DAY = 86400


def flatten_series(payload: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per (location, day) of each response.

    The day is the response's start instant (epoch seconds, taken as a UTC
    calendar day) plus the position in the arrays; the location's département
    and coordinates come from the location table through an explicit id (a
    broadcast join when the table is proven small).
    """
    zipped = payload.select(
        "location_id", "start_time",
        F.posexplode(F.arrays_zip(*[F.col(m) for m in WEATHER_MEASURES])).alias("pos", "v"))
    start_day = F.date_from_unix_date(F.floor(F.col("start_time") / SECONDS_PER_DAY).cast("int"))
    rows = zipped.select(
        "location_id",
        F.date_format(F.date_add(start_day, F.col("pos")), "yyyy-MM-dd").alias("date_ech"),
        *[F.col("v").getField(m).alias(m) for m in WEATHER_MEASURES])
    loc = locations.select("location_id", "code_departement",
                           F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    return (join_small(rows, loc, "location_id", "left")
            .select("date_ech", "code_departement", "latitude", "longitude", *WEATHER_MEASURES))
