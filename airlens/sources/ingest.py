"""Ingest of dated raw files: header check, day filter, idempotent writes by day.

The processed store keeps its rows by ``date_ech`` behind a commit log (:mod:`airlens.sources.manifest`): "is
this day stored" is a look at the newest snapshot, a re-run replaces only its own day, a run that dies leaves
the days as they were, and readers prune days they do not need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, NumericType

from airlens.functions import constants as K
from airlens.sources.schemas import RAW_AIR, RAW_WEATHER
from airlens.sources import manifest
from airlens.sources.store import partition_days, rebalanced


class SchemaError(ValueError):
    """The raw file does not have the expected columns."""


class EmptyDayError(ValueError):
    """The raw file holds no row for the requested day."""


def check_header(columns: Sequence[str], expected: int = K.RAW_AIR_COLUMN_COUNT,
                 required: Sequence[str] = tuple(RAW_AIR.fieldNames())) -> None:
    """Fail before any write when the header has the wrong column count or lacks a used column."""
    if len(columns) != expected:
        raise SchemaError(f"expected {expected} columns, got {len(columns)}")
    missing = [c for c in required if c not in columns]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")


def typed_raw(df: DataFrame, schema=RAW_AIR) -> DataFrame:
    """Cast the used columns of a text frame to the raw types; other columns stay text.

    Integer columns go through double then a half-to-even rounding, so "2" and
    "2.0" both read as 2; bad text fails the job (ANSI casts).
    """
    types = {f.name: f.dataType for f in schema.fields}
    cols = []
    for c in df.columns:
        t = types.get(c)
        if t is None or not isinstance(t, NumericType):
            cols.append(F.col(c))
        elif isinstance(t, IntegerType):
            cols.append(F.rint(F.col(c).cast("double")).cast("int").alias(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return df.select(*cols)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV files with a header as text columns; quotes inside a field are doubled.

    The first file's header gives the columns; every other file must have the same header in the same
    order, else the job fails (instead of reading values into wrong columns). ``multi_line`` allows
    line ends inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("sep", ",").option("encoding", "UTF-8").option("escape", '"')
    columns = reader.csv(path).columns
    text = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    return (reader.schema(text).option("enforceSchema", False).option("mode", "FAILFAST")
            .option("multiLine", multi_line).csv(path))


def read_raw_csv(spark: SparkSession, path: str, expected_columns: int = K.RAW_AIR_COLUMN_COUNT,
                 schema=RAW_AIR) -> DataFrame:
    """Read raw daily CSV: every column as text (the zone code keeps its leading zeros),
    header checked, then the used columns typed."""
    text = read_csv_text(spark, path)
    check_header(text.columns, expected_columns, schema.fieldNames())
    return typed_raw(text, schema)


def read_reference_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A reference table (seed) from CSV with declared column types."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Département centroids (location_id, code_departement, lon, lat).

    The weather service answers in the order of the requested locations, and the request lists
    the centroids in file order, so a location's id is its row number in the file: the place
    within its split plus the rows of the splits before.
    """
    seed = read_reference_csv(spark, path, "code_departement string, lon double, lat double")
    placed = seed.withColumn("_at", F.monotonically_increasing_id()).select(
        "*", F.shiftright("_at", 33).alias("_split"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_row"))
    splits = placed.groupBy("_split").agg(F.count(F.lit(1)).alias("_n"))
    # one row per split of the file
    earlier = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("_split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(before, "_split").select(
        (F.col("_before") + F.col("_row")).cast("int").alias("location_id"), "code_departement", "lon", "lat")


def keep_day(df: DataFrame, day: str) -> DataFrame:
    """Rows of the run day only (observed values, not forecasts); compared as ISO text."""
    return df.filter(F.col("date_ech") == F.lit(day))


def stored_days(spark: SparkSession, root: str) -> DataFrame:
    """Days already in the store, from its partition names (no row is read)."""
    return spark.createDataFrame([(d,) for d in partition_days(spark, root)], "date_ech string")


ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def is_day(day: F.Column) -> F.Column:
    """Is the text a calendar day in ISO form? Null is not."""
    text = day.cast("string")
    return F.coalesce(text.rlike(ISO_DAY) & F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def plan_days(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Per incoming day: its row count and whether it will be saved or skipped.

    Only the day column of the incoming rows is needed (column pruning), and the
    set of stored days has one row per calendar day, so it is broadcast as is.
    """
    per_day = incoming.groupBy(F.col("date_ech").cast("string").alias("date_ech")).agg(
        F.count(F.lit(1)).alias("nb_lignes"))
    marked = stored.select(F.col("date_ech").cast("string").alias("date_ech"), F.lit(True).alias("_stored"))
    joined = per_day.join(F.broadcast(marked), "date_ech", "left")
    return joined.select("date_ech", "nb_lignes",
                         F.when(F.col("_stored"), F.lit("skipped")).otherwise(F.lit("saved")).alias("action"))


def new_days_only(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the incoming days that are not stored yet: a left anti join on the day
    against the stored-day set (one row per calendar day, broadcast)."""
    days = stored.select(F.col("date_ech").cast("string").alias("date_ech"))
    return incoming.withColumn("date_ech", F.col("date_ech").cast("string")).join(F.broadcast(days), "date_ech",
                                                                                   "left_anti")


def write_days(df: DataFrame, root: str) -> dict[str, int]:
    """Write rows into the store; the days present are replaced, all by one commit. Returns the rows of each.

    Rows are rebalanced on the day (AQE splits a day with a large share of the
    rows over several tasks), so each task writes few files.
    """
    base = manifest.snapshot(df.sparkSession, root)
    entries = manifest.store(rebalanced(df, ["date_ech"]), root, manifest.new_commit())
    if entries:
        manifest.publish(df.sparkSession, base, {**base.days, **entries})
    return {d: e["rows"] for d, e in entries.items()}


def ingest_days(spark: SparkSession, incoming: DataFrame, root: str) -> dict:
    """Store every incoming day not stored yet (a backfill); report saved, skipped and rejected.

    The plan needs the day column only; one job then writes all new days. Rows without a
    proper day are not written; they are counted as ``rejected``.
    """
    stored = stored_days(spark, root)
    good = is_day(F.col("date_ech"))
    # one row per calendar day, and one for all rows without one
    days = plan_days(incoming.select(F.when(good, F.col("date_ech").cast("string")).alias("date_ech")), stored).collect()
    report = [r for r in days if r["date_ech"] is not None]
    saved = [r["date_ech"] for r in report if r["action"] == "saved"]
    if saved:
        write_days(new_days_only(incoming.where(good), stored), root)
    return {"saved": len(saved), "skipped": len(report) - len(saved),
            "rejected": sum(r["nb_lignes"] for r in days if r["date_ech"] is None),
            "days": sorted((r["date_ech"], r["action"], r["nb_lignes"]) for r in report)}


def ingest_day(spark: SparkSession, csv_path: str, root: str, day: str,
               expected_columns: int = K.RAW_AIR_COLUMN_COUNT) -> dict:
    """Daily air quality ingest: check the header, keep the run day, skip a day already
    stored, else write its partition; fail when the file has no row for the day.

    The rows are counted from the footers of the written files; without one nothing is
    published, so the failure leaves the store unchanged.
    """
    if day in partition_days(spark, root):
        return {"day": day, "status": "skipped", "rows": None}
    return store_day(keep_day(read_raw_csv(spark, csv_path, expected_columns), day), root, day)


def store_day(rows: DataFrame, root: str, day: str) -> dict:
    """Write the rows of one day; no row is an error, and nothing is published."""
    n = write_days(rows, root).get(day, 0)
    if n == 0:
        raise EmptyDayError(f"0 rows for {day}: check the source")
    return {"day": day, "status": "saved", "rows": n}


def read_store(spark: SparkSession, root: str, schema=RAW_AIR, days: Sequence[str] | None = None) -> DataFrame:
    """The whole store, or the given days, as one DataFrame typed by ``schema``."""
    return manifest.read(spark, root, schema, days)


def write_json(df: DataFrame, path: str, by_day: bool = False) -> None:
    """Records as JSON Lines (one object per line); ``by_day`` keeps one folder per day
    (``day=...``; the records hold ``date_ech``, too) and replaces only the days written."""
    w = df.write.mode("overwrite")
    if by_day:
        w = (df.withColumn("day", F.col("date_ech").cast("string")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("day"))
    w.json(path)


def read_json(spark: SparkSession, path: str, schema=RAW_WEATHER) -> DataFrame:
    return spark.read.schema(schema).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A result as CSV with a header (UTF-8); arrays of names are joined with '|'."""
    from airlens.plans.models import flat
    (flat(df).write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
     .option("escape", '"').csv(path))   # a quote inside a field is doubled
