"""Inputs of the reference's shape, derived from the driver's tables.

The reference's raw files and two of its reference tables are not public, so
the engine's queries run on data derived from the test tables with fixed,
documented formulas: one event is one reading, one user one zone, customers
are communes, suppliers are EPCI, orders give the weather. Every formula is a
built-in expression. Readings grow with the events; the weather does not grow, as all
orders are folded onto 30 days and 25 départements (at most 750 rows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.sources.schemas import WEATHER_MEASURES

# --- fixed values of the derivation ------------------------------------------
FIRST_WEATHER_DAY = "2024-01-01"
WEATHER_DAYS = 30
DEPARTMENT_COUNT = 25
# zone overrides used with the derived data: the real one plus a code that has
# readings and is in neither reference table at sf0.01, so the branch is taken
FIXTURE_ZONE_OVERRIDES = {"200096675": "56", "105": "56"}
# an outage: of the newest day only the zones whose number this divides have sent their readings
OUTAGE_KEEPS = 200
# -------------------------------------------------------------------------------


# declared schemas of the driver's tables that the adapters read (no inference)
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _label(code: F.Column, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr


def raw_readings(events: DataFrame) -> DataFrame:
    """Raw air quality rows (reference file layout, 15 used columns + event_id)."""
    eid, uid, val = F.col("event_id"), F.col("user_id"), F.col("value")
    flat = (eid % 4) == 0

    def sub(other: F.Column) -> F.Column:
        return F.when(flat, F.lit(1)).otherwise(other)

    no2 = sub(1 + eid % 3)
    o3 = sub(1 + F.floor(val).cast("bigint") % 4)
    pm10 = sub(1 + (eid + uid) % 4)
    pm25 = sub(1 + F.floor(eid / 7).cast("bigint") % 5)
    so2_base = sub(1 + uid % 2)
    so2 = F.when(eid % 71 == 0, F.lit(None)).otherwise(so2_base)
    qual = (F.when(eid % 53 == 0, F.lit(0))
            .when(eid % 59 == 0, F.lit(7))
            .when(val > 200, F.lit(6))
            .otherwise(F.greatest(no2, o3, pm10, pm25, so2_base)))
    out = events.select(
        F.col("ts").cast("date").cast("string").alias("date_ech"),
        uid.cast("string").alias("code_zone"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Zone "), (uid % 40).cast("string"))).alias("lib_zone"),
        F.when(uid % 4 == 0, F.lit("EPCI")).otherwise(F.lit("commune")).alias("type_zone"),
        F.col("event_type").alias("source"),
        eid.alias("event_id"),
        qual.cast("int").alias("code_qual"),
        no2.cast("int").alias("code_no2"),
        o3.cast("int").alias("code_o3"),
        pm10.cast("int").alias("code_pm10"),
        pm25.cast("int").alias("code_pm25"),
        so2.cast("int").alias("code_so2"),
        F.when(eid % 61 == 0, F.lit(900000.0))
         .otherwise((uid % 100).cast("double") / 10 - 3).alias("x_wgs84"),
        (42 + (uid % 80).cast("double") / 10).alias("y_wgs84"),
    )
    return (out
            .withColumn("lib_qual", _label(F.col("code_qual"), K.INDEX_LABELS))
            .withColumn("coul_qual", _label(F.col("code_qual"), K.INDEX_COLOURS)))


def with_outage(raw: DataFrame) -> DataFrame:
    """The readings of a day on which most zones failed to report (the monitors are CRITICAL from sf0.01 on)."""
    newest = raw.select(F.max("date_ech")).scalar()
    return raw.where((F.col("date_ech") < newest) | (F.col("code_zone").cast("bigint") % OUTAGE_KEEPS == 0))


def former_communes(communes: DataFrame) -> DataFrame:
    """An older reference table: every tenth commune still in the département of the next number."""
    moved = F.lpad(((F.col("DEP").cast("int") + 1) % DEPARTMENT_COUNT).cast("string"), 2, "0")
    return communes.withColumn("DEP", F.when(F.col("COM").cast("bigint") % 10 == 0, moved).otherwise(F.col("DEP")))


def communes(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.cast("string").alias("COM"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("DEP"),
        F.when(key % 5 == 0, F.lit("COMD")).otherwise(F.lit("COM")).alias("TYPECOM"),
    )


def epci(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.concat(F.col("s_suppkey").cast("string"), F.lit(",x")).alias("SIREN"),
        F.concat(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit(",99")).alias("code_departement"),
        F.lit(None).cast("string").alias("code_region"),
    )


def raw_weather(orders: DataFrame) -> DataFrame:
    """One weather row per (day, département), aggregated from orders."""
    keyed = orders.select(
        F.date_add(F.lit(FIRST_WEATHER_DAY).cast("date"),
                   (F.col("o_orderkey") % WEATHER_DAYS).cast("int")).cast("string").alias("date_ech"),
        F.lpad((F.col("o_custkey") % DEPARTMENT_COUNT).cast("string"), 2, "0").alias("code_departement"),
        "o_orderkey", "o_custkey",
    )
    agg = keyed.groupBy("date_ech", "code_departement").agg(
        F.sum("o_orderkey").alias("so"), F.sum("o_custkey").alias("sc"), F.max("o_orderkey").alias("mo"))
    dnum = F.col("code_departement").cast("int").cast("double")
    return agg.select(
        "date_ech", "code_departement",
        (F.lit(42.0) + dnum * 0.25).alias("latitude"),
        (F.lit(-4.5) + dnum * 0.5).alias("longitude"),
        ((F.col("so") % 250).cast("double") / 10).alias("temperature_mean"),
        ((F.col("so") % 350).cast("double") / 10).alias("temperature_max"),
        ((F.col("so") % 150).cast("double") / 10 - 5).alias("temperature_min"),
        ((F.col("sc") % 50).cast("double") / 10).alias("rain_sum"),
        ((F.col("sc") % 600).cast("double") / 10).alias("wind_speed_max"),
        ((F.col("sc") % 80).cast("double") / 10).alias("precipitation_sum"),
        (F.col("mo") % 4).cast("double").alias("weathercode"),
    )


def centroids(weather: DataFrame) -> DataFrame:
    """Location table of the weather service: id, département, lon, lat."""
    return (weather.select(F.col("code_departement").cast("int").alias("location_id"),
                           "code_departement",
                           F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
            .dropDuplicates(["location_id"]))


def weather_payload(weather: DataFrame) -> DataFrame:
    """Responses of the weather service rebuilt from daily rows.

    One response per (location, month): a start instant and one array per
    measure covering every day from the first to the last day present, null
    where a day is absent. A group holds at most 31 days, whatever the size of
    the input.
    """
    day = F.to_date("date_ech")
    values = F.struct(*[F.col(m) for m in WEATHER_MEASURES])
    grouped = (weather
               .withColumn("day", day)
               .groupBy(F.col("code_departement").cast("int").alias("location_id"),
                        F.trunc(day, "month").alias("month"))
               .agg(F.min("day").alias("lo"), F.max("day").alias("hi"),
                    F.map_from_entries(F.collect_list(F.struct("day", values))).alias("by_day")))
    days = F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))
    cols = [F.col("location_id"), (F.unix_date("lo").cast("bigint") * 86400).alias("start_time")]

    def measure_of(m: str):
        return lambda d: F.try_element_at(F.col("by_day"), d)[m]

    for m in WEATHER_MEASURES:
        cols.append(F.transform(days, measure_of(m)).alias(m))
    return grouped.select(*cols)


@dataclass
class Inputs:
    """The derived inputs of one scale factor directory."""

    raw_air: DataFrame
    communes: DataFrame
    epci: DataFrame
    raw_weather: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        return cls(
            raw_air=raw_readings(table(spark, sf_dir, "events")),
            communes=communes(table(spark, sf_dir, "customer")),
            epci=epci(table(spark, sf_dir, "supplier")),
            raw_weather=raw_weather(table(spark, sf_dir, "orders")),
        )
