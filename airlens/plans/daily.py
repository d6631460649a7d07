"""The daily runs a scheduler calls: air quality (ingest, rebuild, gate) and weather.

Run day and paths are plain arguments.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from airlens.functions import constants as K
from airlens.plans.rebuild import days_to_build, rebuild_weather, run_all, run_days
from airlens.sources import ingest
from airlens.sources.payload import flatten_series
from airlens.sources.schemas import RAW_WEATHER
from airlens.sources.store import partition_days


def daily_air_run(spark: SparkSession, csv_path: str, day: str, air_root: str, communes: DataFrame,
                  epci: DataFrame, out_root: str, weather_root: str | None = None,
                  overrides: Mapping[str, str] = K.ZONE_OVERRIDES,
                  expected_columns: int = K.RAW_AIR_COLUMN_COUNT, incremental: bool = False) -> dict:
    """Ingest the day's file (header check, day filter, skip when stored, fail on no row),
    rebuild the tables, then stop on a CRITICAL monitor.

    By default every table is rebuilt from all stored days; ``incremental``
    rebuilds only what the new days change (:func:`~airlens.plans.rebuild.run_days`): the run day and every
    stored day that is not built from its present files.
    """
    result = ingest.ingest_day(spark, csv_path, air_root, day, expected_columns)
    has_weather = weather_root is not None and partition_days(spark, weather_root)
    weather = weather_root if has_weather else None
    if incremental:
        new = {day, *days_to_build(spark, air_root, weather, out_root)}
        tables = run_days(spark, new, air_root, weather, communes, epci, out_root, overrides, gate=True)
    else:
        tables = run_all(spark, air_root, weather, communes, epci, out_root, overrides, gate=True)
    return {"ingest": result, "tables": sorted(tables)}


def daily_weather_run(spark: SparkSession, payload: DataFrame, locations: DataFrame, day: str,
                      weather_root: str, out_root: str, json_root: str | None = None) -> dict:
    """Store the day's weather rows (skipped when the day is stored), keep a JSON copy of
    the records, then replace that day in weather staging and in its join with the
    stored daily mart."""
    if day in partition_days(spark, weather_root):
        return {"day": day, "status": "skipped"}
    saved = ingest.store_day(ingest.keep_day(flatten_series(payload, locations), day), weather_root, day)
    if json_root is not None:
        stored = ingest.read_store(spark, weather_root, RAW_WEATHER, [day])
        ingest.write_json(stored, json_root, by_day=True)
    if partition_days(spark, f"{out_root.rstrip('/')}/mart_atmo_daily_departement"):
        rebuild_weather(spark, weather_root, out_root, day)
    return {"day": day, "status": saved["status"]}


def backfill_weather(spark: SparkSession, payload: DataFrame, locations: DataFrame, weather_root: str,
                     json_root: str | None = None) -> dict:
    """Store every day of a multi-day payload not stored yet, in one job; report saved and skipped."""
    rows = flatten_series(payload, locations)
    if json_root is not None:
        stored = ingest.stored_days(spark, weather_root)
        ingest.write_json(ingest.new_days_only(rows, stored), json_root, by_day=True)
    return ingest.ingest_days(spark, rows, weather_root)
