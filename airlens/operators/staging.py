"""Staging models: cleaned, typed, deduplicated readings and weather rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.functions.expr import argmax_names, round_float, to_small_int, valid_pair
from airlens.operators.joins import BROADCAST_MAX_BYTES, join_small


def commune_dimension(communes: DataFrame) -> DataFrame:
    """Commune reference table without delegated communes: (code_zone, dept)."""
    return (communes
            .filter(F.col("TYPECOM") != K.DELEGATED_COMMUNE_TYPE)
            .select(F.col("COM").cast("string").alias("code_zone"),
                    F.col("DEP").cast("string").alias("dept")))


def epci_dimension(epci: DataFrame) -> DataFrame:
    """EPCI reference table, first item of each comma list: (code_zone, dept)."""
    return epci.select(
        F.split_part(F.col("SIREN").cast("string"), F.lit(","), F.lit(1)).alias("code_zone"),
        F.split_part(F.col("code_departement").cast("string"), F.lit(","), F.lit(1)).alias("dept"))


def _zone_rows(communes: DataFrame, epci: DataFrame) -> DataFrame:
    c = commune_dimension(communes).select("code_zone", F.col("dept").alias("commune_dept"),
                                           F.lit(None).cast("string").alias("epci_dept"))
    e = epci_dimension(epci).select("code_zone", F.lit(None).cast("string").alias("commune_dept"),
                                    F.col("dept").alias("epci_dept"))
    return c.unionByName(e)


def zone_lookup(communes: DataFrame, epci: DataFrame) -> DataFrame:
    """One row per zone code with its commune and EPCI département.

    Both reference tables go into one keyed table, so staging needs a single
    join; a code listed twice in a table keeps its smallest département, so the
    join can never multiply readings.
    """
    return (_zone_rows(communes, epci)
            .groupBy("code_zone")
            .agg(F.min("commune_dept").alias("commune_dept"), F.min("epci_dept").alias("epci_dept")))


def resolve_department(code: F.Column, commune_dept: F.Column, epci_dept: F.Column,
                       overrides: Mapping[str, str] = K.ZONE_OVERRIDES) -> F.Column:
    """Commune table, then EPCI table, then hand-made overrides, then the first two characters."""
    manual = None
    for zone, dept in overrides.items():
        manual = F.when(code == zone, F.lit(dept)) if manual is None else manual.when(code == zone, F.lit(dept))
    parts = [commune_dept, epci_dept] + ([manual] if manual is not None else []) + [F.left(code, F.lit(2))]
    return F.coalesce(*parts)


def zone_departments(communes: DataFrame, epci: DataFrame, overrides: Mapping[str, str] = K.ZONE_OVERRIDES) -> DataFrame:
    """(code_zone, dept) of every code that the reference tables or the overrides name: what staging resolves it to."""
    named = _zone_rows(communes, epci)
    if overrides:
        by_hand = communes.sparkSession.createDataFrame([(c,) for c in sorted(overrides)], "code_zone string")
        named = named.unionByName(by_hand, allowMissingColumns=True)
    zones = named.where(F.col("code_zone").isNotNull()).groupBy("code_zone").agg(
        F.min("commune_dept").alias("commune_dept"), F.min("epci_dept").alias("epci_dept"))
    dept = resolve_department(F.col("code_zone"), F.col("commune_dept"), F.col("epci_dept"), overrides)
    return zones.select("code_zone", dept.alias("dept"))


def changed_zones(before: DataFrame, after: DataFrame) -> DataFrame:
    """Codes that resolve to another département after than before (code_zone, dept); an unnamed code to its first letters."""
    a = before.select("code_zone", F.col("dept").alias("old"), F.lit(True).alias("had"))
    b = after.select("code_zone", F.col("dept").alias("new"), F.lit(True).alias("has"))
    short = F.left("code_zone", F.lit(2))
    old, new = F.when(F.col("had"), F.col("old")).otherwise(short), F.when(F.col("has"), F.col("new")).otherwise(short)
    return a.join(b, "code_zone", "full").where(~old.eqNullSafe(new)).select("code_zone")


# order among readings of one (code, name, day): worst index first, then every
# other published column so the kept row does not depend on the input order
DEDUPE_TIE_BREAKERS = ("source_aasqa", "type_zone", "lib_qual", "coul_qual", "code_no2", "code_o3",
                       "code_pm10", "code_pm25", "code_so2", "longitude", "latitude", "code_departement")


def dedupe_order() -> list[F.Column]:
    return [F.col("code_qual").desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in DEDUPE_TIE_BREAKERS]

STAGING_COLUMNS = ["date_ech", "code_insee", "nom_commune", "type_zone", "source_aasqa", "code_qual",
                   "lib_qual", "coul_qual", "code_no2", "code_o3", "code_pm10", "code_pm25", "code_so2",
                   "polluants_declencheurs", "code_departement", "longitude", "latitude"]


def clean_readings(raw: DataFrame) -> DataFrame:
    """Drop sentinel indices and null codes; filters sit on raw columns so they reach the scan."""
    cond = F.col("code_zone").isNotNull()
    for c in K.INDEX_COLUMNS:
        cond = cond & ~F.col(c).isin(*K.SENTINEL_INDICES)
    return raw.filter(cond)


def newest_day(raw: DataFrame) -> F.Column:
    """The newest day of staging, from the raw rows: the dedupe never removes a day."""
    return clean_readings(raw).select(F.max(F.col("date_ech").cast("date"))).scalar()


def days(raw: DataFrame) -> DataFrame:
    """The days of staging (one row each), from the raw rows."""
    return clean_readings(raw).select(F.col("date_ech").cast("date").alias("date_ech")).distinct()


def dedupe_worst(df: DataFrame, keys=("code_insee", "nom_commune", "date_ech"), order=None) -> DataFrame:
    """Keep the worst reading of each (code, name, day).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so each task sends one row per key: a hot key costs no more than
    any other.
    """
    w = Window.partitionBy(*keys).orderBy(*(order or dedupe_order()))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def air_staging(raw: DataFrame, communes: DataFrame, epci: DataFrame,
                overrides: Mapping[str, str] = K.ZONE_OVERRIDES,
                broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``stg_atmo_daily``: typed readings, département resolved, worst reading per (code, name, day)."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    lookup = zone_lookup(communes, epci)
    joined = join_small(clean_readings(raw).withColumn("code_zone", F.col("code_zone").cast("string")),
                        lookup, "code_zone", "left", broadcast_max_bytes)
    code = F.col("code_zone")
    x = F.col("x_wgs84").cast("float")
    y = F.col("y_wgs84").cast("float")
    inside = valid_pair(x, y)
    subs = [to_small_int(c, types[c]) for c in K.SUB_INDEX_COLUMNS]
    cleaned = joined.select(
        F.col("date_ech").cast("date").alias("date_ech"),
        code.alias("code_insee"),
        F.col("lib_zone").alias("nom_commune"),
        F.col("type_zone"),
        F.col("source").alias("source_aasqa"),
        to_small_int("code_qual", types["code_qual"]).alias("code_qual"),
        F.col("lib_qual"),
        F.col("coul_qual"),
        *[s.alias(c) for s, c in zip(subs, K.SUB_INDEX_COLUMNS)],
        argmax_names(subs).alias("polluants_declencheurs"),
        resolve_department(code, F.col("commune_dept"), F.col("epci_dept"), overrides).alias("code_departement"),
        F.when(inside, x).alias("longitude"),
        F.when(inside, y).alias("latitude"),
    )
    return dedupe_worst(cleaned).select(*STAGING_COLUMNS)


def weather_staging(raw: DataFrame) -> DataFrame:
    """``stg_meteo_daily``: typed weather rows, measures rounded to one decimal (not deduplicated)."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(
        F.col("date_ech").cast("date").alias("date_ech"),
        F.col("code_departement").cast("string").alias("code_departement"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        *[round_float(m, 1).alias(m) for m in ("temperature_mean", "temperature_max", "temperature_min",
                                                 "rain_sum", "precipitation_sum", "wind_speed_max")],
        to_small_int("weathercode", types["weathercode"], "smallint").alias("weathercode"),
    )
