"""Marts: zone profile, daily département and national summaries, weather join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.functions.expr import count_where, dominant, pct, pollutant_columns, round_half

LEVEL_SUFFIXES = ("bon", "moyen", "degrade", "mauvais", "tres_mauvais", "extremement_mauvais")


def _level_counts(prefix: str):
    return [count_where(F.col("code_qual") == level).alias(f"{prefix}{suffix}")
            for level, suffix in zip(K.INDEX_LEVELS, LEVEL_SUFFIXES)]


def _trigger_pcts():
    return [pct(F.array_contains("polluants_declencheurs", p)).alias(f"pct_{p.lower()}_declencheur")
            for p in K.POLLUTANTS]


TRIGGER_PCT_COLUMNS = pollutant_columns("pct", "declencheur")
MEAN_COLUMNS = pollutant_columns("indice_moyen")


ZONE_KEYS = ["code_insee", "nom_commune", "code_departement"]
_SUMMED = ["code_qual", *K.SUB_INDEX_COLUMNS]
_COUNTED = ["jours", "lignes", "acceptables", *[f"jours_{suffix}" for suffix in LEVEL_SUFFIXES],
            *[f"{part}_{c}" for c in _SUMMED for part in ("somme", "n")]]


def profile_sums(stg: DataFrame, *keys) -> DataFrame:
    """What the zone profile is made of, per zone (and ``keys``): first and last day, exact integer sums and counts.

    Sums of different days add up (:func:`merge_sums`), so a stored profile grows by the new days' sums alone.
    Staging has one row per (code, name, day), and the département follows from the code,
    so the rows of a group are its days: a plain count, one partial aggregate and one shuffle.
    """
    return stg.groupBy(*keys, *ZONE_KEYS).agg(
        F.min("date_ech").alias("premiere_date"),
        F.max("date_ech").alias("derniere_date"),
        F.count("date_ech").alias("jours"),
        F.count(F.lit(1)).alias("lignes"),
        F.count_if(F.col("code_qual") <= K.ACCEPTABLE_MAX).alias("acceptables"),
        *_level_counts("jours_"),
        *[x for c in _SUMMED for x in (F.sum(F.col(c).cast("long")).alias(f"somme_{c}"), F.count(c).alias(f"n_{c}"))],
    )


def merge_sums(sums: DataFrame, *keys) -> DataFrame:
    """Sums of disjoint sets of rows as one row per zone (and ``keys``)."""
    return sums.groupBy(*keys, *ZONE_KEYS).agg(
        F.min("premiere_date").alias("premiere_date"), F.max("derniere_date").alias("derniere_date"),
        *[F.sum(c).alias(c) for c in _COUNTED])


def profile_of_sums(sums: DataFrame) -> DataFrame:
    """``mart_atmo_commune`` from one row of sums per zone."""
    def mean(c: str):
        return round_half(F.try_divide(F.col(f"somme_{c}").cast("double"), F.col(f"n_{c}").cast("double")), 2)

    out = sums.select(
        *ZONE_KEYS, "premiere_date", "derniere_date", F.col("jours").alias("nb_jours_mesures"),
        *[F.col(f"jours_{suffix}").alias(f"nb_jours_{suffix}") for suffix in LEVEL_SUFFIXES],
        mean("code_qual").alias("indice_moyen"),
        *[mean(c).alias(m) for c, m in zip(K.SUB_INDEX_COLUMNS, MEAN_COLUMNS)],
        round_half(F.lit(100.0) * F.col("acceptables") / F.col("lignes"), 1).alias("pct_jours_acceptable"),
    )
    # dominant pollutants compare the rounded means, as published
    return out.withColumn("polluants_dominants", dominant("indice_moyen"))


def zone_profile(stg: DataFrame) -> DataFrame:
    """``mart_atmo_commune``: one row per (code, name, département) over the whole period, by one shuffle."""
    return profile_of_sums(profile_sums(stg))


def daily_department(stg: DataFrame) -> DataFrame:
    """``mart_atmo_daily_departement``: one row per (day, département)."""
    agg = stg.groupBy("date_ech", "code_departement").agg(
        F.count_distinct("code_insee").alias("nb_communes"),
        round_half(F.avg("code_qual"), 2).alias("indice_moyen"),
        *_level_counts("nb_"),
        pct(F.col("code_qual") <= K.ACCEPTABLE_MAX).alias("pct_acceptable"),
        *_trigger_pcts(),
    )
    return agg.withColumn("polluants_dominants_departement", dominant("pct", "declencheur"))


NATIONAL_COLUMNS = ["date_ech", "nb_communes", "indice_moyen_national", "nb_bon", "nb_mauvais_ou_pire",
                    "polluants_dominants_national"] + TRIGGER_PCT_COLUMNS


def daily_national(stg: DataFrame) -> DataFrame:
    """``mart_atmo_daily_national``: one row per day; rows, not distinct zones, are counted."""
    agg = stg.groupBy("date_ech").agg(
        F.count(F.lit(1)).alias("nb_communes"),
        round_half(F.avg("code_qual"), 2).alias("indice_moyen_national"),
        count_where(F.col("code_qual") == 1).alias("nb_bon"),
        count_where(F.col("code_qual") >= K.BAD_MIN).alias("nb_mauvais_ou_pire"),
        *_trigger_pcts(),
    )
    return (agg.withColumn("polluants_dominants_national", dominant("pct", "declencheur"))
            .select(*NATIONAL_COLUMNS))


WEATHER_JOIN_COLUMNS = ["temperature_max", "temperature_min", "rain_sum", "precipitation_sum",
                        "wind_speed_max", "weathercode"]


def daily_with_weather(dep: DataFrame, weather: DataFrame) -> DataFrame:
    """``mart_atmo_meteo_daily_departement``: daily département rows with that day's weather.

    A left join on (day, département). The département mart leaves its
    aggregate already hash-partitioned on these keys, so only the weather side
    is shuffled. Weather is not deduplicated: a repeated key repeats the row.
    """
    w = weather.select("date_ech", "code_departement", *WEATHER_JOIN_COLUMNS)
    return (dep.select("date_ech", "code_departement", "indice_moyen", "polluants_dominants_departement")
            .join(w, ["date_ech", "code_departement"], "left"))
