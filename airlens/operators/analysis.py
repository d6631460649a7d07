"""Analyses over staging and marts: anomalies, rankings, search, weather profiles.

Every function maps DataFrames to a DataFrame. Rankings give a total order
(measure, then keys) so a limit returns the same rows on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.functions.expr import bands_ascending, bands_descending, count_where, round_half


# --- anomalies -------------------------------------------------------------------------

def duplicate_zone_codes(profile: DataFrame) -> DataFrame:
    """Zone profile rows whose code appears on more than one row (shared codes, border zones).

    A row count over the profile partitioned by code: the profile has one row
    per (code, name, département), so a code's group holds a handful of rows,
    and the profile is computed once (no second pass for a semi join). A null
    code never qualifies, as with ``IN``.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("code_insee"))
    return (profile.filter(F.col("code_insee").isNotNull())
            .withColumn("_n", n).filter(F.col("_n") > 1).drop("_n"))


def unnamed_zones(stg: DataFrame) -> DataFrame:
    """Rows with a missing or empty name, counted per (code, name)."""
    name = F.col("nom_commune")
    return (stg.filter(name.isNull() | (name == ""))
            .groupBy("code_insee", "nom_commune").agg(F.count(F.lit(1)).alias("nb_lignes")))


def zone_history(stg: DataFrame, code: str) -> DataFrame:
    """All readings of one zone code, newest first."""
    return stg.filter(F.col("code_insee") == code).orderBy(F.col("date_ech").desc(), F.col("nom_commune").asc_nulls_last())


def zones_of_type(stg: DataFrame, zone_type: str = "EPCI") -> DataFrame:
    """Readings of one zone type, newest first."""
    return stg.filter(F.col("type_zone") == zone_type).orderBy(F.col("date_ech").desc(), "code_insee")


def zones_in_departments(stg: DataFrame, departments: Sequence[str]) -> DataFrame:
    """Readings of a list of départements (for instance the '20' that unmatched EPCI fall back to)."""
    return stg.filter(F.col("code_departement").isin(*departments))


def zones_lost(stg: DataFrame, day_from=None, day_to=None, today=None) -> DataFrame:
    """Readings of a day whose code has no reading on the later day.

    With two days given, the rows of ``day_from`` absent on ``day_to``; with
    none, every day but the newest against the next calendar day, over the whole table. If
    the next day has no row at all, all zones of the day are lost.
    A correlated NOT EXISTS, planned as a left anti join on (code, day).
    """
    later = stg.select(F.col("code_insee").alias("_code"), F.col("date_ech").alias("_day")).distinct()
    if day_from is not None:
        later = later.filter(F.col("_day") == F.lit(day_to).cast("date"))
        return stg.filter(F.col("date_ech") == F.lit(day_from).cast("date")).join(
            later, F.col("code_insee") == F.col("_code"), "left_anti")
    newest = newest_day(stg) if today is None else today
    cond = (F.col("code_insee") == F.col("_code")) & (F.date_add(F.col("date_ech"), 1) == F.col("_day"))
    return stg.filter(F.col("date_ech") < newest).join(later, cond, "left_anti")


def odd_codes(stg: DataFrame, min_length: int = 5, excluded_prefix: str = "2000", n: int = 20) -> DataFrame:
    """Distinct (code, name, first two characters) of codes longer than ``min_length``
    that do not start with ``excluded_prefix``; the first ``n`` by code."""
    code = F.col("code_insee").cast("string")
    return (stg.filter((F.length(code) > min_length)
                       & (F.left(code, F.lit(len(excluded_prefix))) != excluded_prefix))
            .select("code_insee", "nom_commune", F.left(code, F.lit(2)).alias("debut"))
            .distinct()
            .orderBy("code_insee", F.col("nom_commune").asc_nulls_last())
            .limit(n))


def index_ranges(stg: DataFrame) -> DataFrame:
    """Smallest and largest value of each sub-index (one global aggregate)."""
    cols = []
    for c, p in zip(K.SUB_INDEX_COLUMNS, K.POLLUTANTS):
        cols += [F.min(c).alias(f"min_{p.lower()}"), F.max(c).alias(f"max_{p.lower()}")]
    return stg.agg(*cols)


def department_centroids(stg: DataFrame) -> DataFrame:
    """Mean position of each département's readings with coordinates, 4 decimals."""
    return (stg.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
            .groupBy("code_departement")
            .agg(round_half(F.avg("longitude"), 4).alias("lon"), round_half(F.avg("latitude"), 4).alias("lat")))


# --- rankings and selections -------------------------------------------------------------

def profile_selection(profile: DataFrame, min_days: int = 2) -> DataFrame:
    """Zone profiles with at least ``min_days`` measured days (the dashboard's zone table)."""
    return profile.filter(F.col("nb_jours_mesures") >= min_days).select(
        "code_insee", "nom_commune", "code_departement", "indice_moyen", "pct_jours_acceptable",
        "polluants_dominants", "nb_jours_mesures", "premiere_date", "derniere_date",
        "indice_moyen_no2", "indice_moyen_o3", "indice_moyen_pm10", "indice_moyen_pm25", "indice_moyen_so2")


def _zone_key() -> list[Column]:
    return [F.col("code_insee").asc_nulls_last(), F.col("nom_commune").asc_nulls_last(),
            F.col("code_departement").asc_nulls_last()]


def best_zones(profile: DataFrame, min_days: int = 7, n: int = 20) -> DataFrame:
    """Top ``n`` zones by lowest mean index among those with ``min_days`` measured days."""
    return (profile.filter(F.col("nb_jours_mesures") >= min_days)
            .select("code_insee", "nom_commune", "nb_jours_mesures", "indice_moyen", "pct_jours_acceptable")
            .orderBy(F.col("indice_moyen").asc_nulls_last(), *_zone_key())
            .limit(n))


def ranked_named_zones(profile: DataFrame, n: int = 15, worst: bool = False, min_days: int = 2) -> DataFrame:
    """The ``n`` best (or worst) named zones of the selection; ties by code then name."""
    measure = F.col("indice_moyen").desc_nulls_last() if worst else F.col("indice_moyen").asc_nulls_last()
    return (profile_selection(profile, min_days)
            .filter(F.col("nom_commune").isNotNull() & F.col("indice_moyen").isNotNull())
            .select("nom_commune", "code_departement", "indice_moyen", "pct_jours_acceptable", "code_insee")
            .orderBy(measure, *_zone_key())
            .limit(n))


def search_zones(profile: DataFrame, term: str, min_days: int = 2) -> DataFrame:
    """Zones whose lower-cased name contains the lower-cased term, or whose code contains it.

    The term is a regular expression, matched anywhere (``rlike``); the code
    match is case-sensitive; a null name does not match.
    """
    name_hit = F.coalesce(F.lower(F.col("nom_commune")).rlike(term.lower()), F.lit(False))
    code_hit = F.coalesce(F.col("code_insee").cast("string").rlike(term), F.lit(False))
    return (profile_selection(profile, min_days).filter(name_hit | code_hit)
            .select("nom_commune", "code_insee", "code_departement", "indice_moyen", "pct_jours_acceptable",
                    "indice_moyen_no2", "indice_moyen_o3", "indice_moyen_pm10", "indice_moyen_pm25")
            .orderBy(F.col("indice_moyen").asc_nulls_last(), *_zone_key()))


def newest_day(df: DataFrame) -> Column:
    """The newest ``date_ech`` of ``df`` as a scalar subquery."""
    return df.select(F.max("date_ech")).scalar()


def rows_of_day(dep: DataFrame, day=None) -> DataFrame:
    """Daily département rows of one day (default: the newest day)."""
    d = newest_day(dep) if day is None else F.lit(day).cast("date")
    return dep.filter(F.col("date_ech") == d)


def worst_departments_of_day(dep: DataFrame, day=None, n: int = 5) -> DataFrame:
    return (rows_of_day(dep, day).select("date_ech", "code_departement", "indice_moyen", "nb_communes")
            .orderBy(F.col("indice_moyen").desc_nulls_last(), F.col("code_departement").asc_nulls_last())
            .limit(n))


def mean_of_day(dep: DataFrame, day=None) -> DataFrame:
    """Unweighted mean of the départements' mean index on a day, 2 decimals."""
    return (rows_of_day(dep, day).groupBy("date_ech")
            .agg(round_half(F.avg("indice_moyen"), 2).alias("indice_jour"),
                 F.count(F.lit(1)).alias("nb_departements")))


def dominant_of_day(dep: DataFrame, day=None) -> DataFrame:
    """Pollutant listed most often among the départements' dominant lists of a day.

    Ties go to the name first in alphabetical order.
    """
    items = rows_of_day(dep, day).select("date_ech", F.explode("polluants_dominants_departement").alias("polluant"))
    return (items.groupBy("date_ech", "polluant").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col("polluant").asc())
            .limit(1))


def headline(national: DataFrame) -> DataFrame:
    """Figures of the newest of the given national days (give that day's rows alone where it is known);
    percent good is 0 when the day has no rows."""
    top = national.orderBy(F.col("date_ech").desc_nulls_last()).limit(1)
    n = F.col("nb_communes")
    return top.select(
        "date_ech", "indice_moyen_national", "nb_communes", "nb_bon", "nb_mauvais_ou_pire",
        F.when(n > 0, round_half(F.lit(100.0) * F.col("nb_bon") / n, 1)).otherwise(F.lit(0.0)).alias("pct_bon"))


def available_days(dep: DataFrame) -> DataFrame:
    """Days present in the département mart, newest first, with their ISO and month-day labels."""
    return (dep.select("date_ech").distinct()
            .select("date_ech", F.date_format("date_ech", "yyyy-MM-dd").alias("jour"),
                    F.date_format("date_ech", "MM-dd").alias("mois_jour"))
            .orderBy(F.col("date_ech").desc()))


# --- national views --------------------------------------------------------------------

def national_selection(national: DataFrame) -> DataFrame:
    return (national.select("date_ech", "indice_moyen_national", "nb_communes", "nb_bon", "nb_mauvais_ou_pire",
                            "polluants_dominants_national")
            .orderBy(F.col("date_ech").desc()))


def department_selection(dep: DataFrame) -> DataFrame:
    return (dep.select("date_ech", "code_departement", "indice_moyen", "nb_communes",
                       "polluants_dominants_departement", "pct_no2_declencheur", "pct_o3_declencheur",
                       "pct_pm10_declencheur", "pct_pm25_declencheur", "pct_so2_declencheur")
            .orderBy(F.col("date_ech").desc(), F.col("code_departement").asc_nulls_last()))


# --- weather ---------------------------------------------------------------------------

def weather_code_profile(joined: DataFrame, pollutant: str | None = None) -> DataFrame:
    """Per weather code: mean index, rows, mean max temperature and wind.

    With ``pollutant``, only days where it is among the département's dominant
    pollutants (and mean precipitation instead of temperature).
    """
    df = joined
    if pollutant is not None:
        df = df.filter(F.array_contains("polluants_dominants_departement", pollutant))
        extra = [round_half(F.avg("wind_speed_max"), 1).alias("vent_moy"),
                 round_half(F.avg("precipitation_sum"), 1).alias("precipitation_moy")]
    else:
        extra = [round_half(F.avg("temperature_max"), 1).alias("temp_max_moy"),
                 round_half(F.avg("wind_speed_max"), 1).alias("vent_moy")]
    return (df.groupBy("weathercode")
            .agg(round_half(F.avg("indice_moyen"), 2).alias("indice_moyen"),
                 F.count(F.lit(1)).alias("nb_observations"), *extra)
            .orderBy(F.col("indice_moyen").desc_nulls_last(), F.col("weathercode").asc_nulls_last()))


def index_band_weather(joined: DataFrame) -> DataFrame:
    """Weather means per band of mean index (a null index falls in the last band)."""
    band = bands_descending("indice_moyen", K.INDEX_BANDS, K.INDEX_BAND_ELSE).alias("qualite")
    return (joined.groupBy(band)
            .agg(round_half(F.avg("temperature_max"), 1).alias("temp_max_moy"),
                 round_half(F.avg("temperature_min"), 1).alias("temp_min_moy"),
                 round_half(F.avg("wind_speed_max"), 1).alias("vent_moy"),
                 round_half(F.avg("precipitation_sum"), 1).alias("precipitation_moy"),
                 F.count(F.lit(1)).alias("nb_observations"))
            .orderBy("qualite"))


def wind_band_index(joined: DataFrame) -> DataFrame:
    band = bands_ascending("wind_speed_max", K.WIND_BANDS, K.WIND_BAND_ELSE).alias("categorie_vent")
    return (joined.groupBy(band)
            .agg(round_half(F.avg("indice_moyen"), 2).alias("indice_moyen"),
                 F.count(F.lit(1)).alias("nb_observations"))
            .orderBy(F.col("indice_moyen").desc_nulls_last(), "categorie_vent"))


def temperature_band_o3(joined: DataFrame) -> DataFrame:
    band = bands_ascending("temperature_max", K.TEMPERATURE_BANDS, K.TEMPERATURE_BAND_ELSE).alias("categorie_temp")
    return (joined.groupBy(band)
            .agg(round_half(F.avg("indice_moyen"), 2).alias("indice_moyen"),
                 count_where(F.array_contains("polluants_dominants_departement", "O3")).alias("nb_fois_o3_dominant"),
                 F.count(F.lit(1)).alias("nb_observations"))
            .orderBy(F.col("indice_moyen").desc_nulls_last(), "categorie_temp"))


def temperature_vs_index(joined: DataFrame) -> DataFrame:
    """National daily mean of max temperature against mean index (days with a temperature)."""
    return (joined.filter(F.col("temperature_max").isNotNull())
            .groupBy("date_ech")
            .agg(round_half(F.avg("temperature_max"), 1).alias("temperature_max"),
                 round_half(F.avg("indice_moyen"), 2).alias("indice_moyen"))
            .withColumn("mois_jour", F.date_format("date_ech", "MM-dd"))
            .orderBy("date_ech"))
