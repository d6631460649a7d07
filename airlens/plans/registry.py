"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracle.

Every query starts from the driver's tables (through the adapters of
``airlens.sources.fixtures``) and runs over all their rows; those that read staging several
times, and the ingest queries, write tables first. Arrays of names are returned joined with '|'.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.functions import constants as K
from airlens.operators import analysis as A
from airlens.operators import marts, monitoring, quality, staging
from airlens.plans import oracle as O
from airlens.plans import rebuild, sqlapi
from airlens.plans.daily import daily_air_run
from airlens.plans.models import Models, flat
from airlens.session import fresh_path
from airlens.sources import fixtures, ingest, payload
from airlens.sources.schemas import RAW_AIR, RAW_WEATHER
from airlens.sources.store import open_table
from airlens.streaming.file_ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]

# parameters of the registered analyses, chosen for the derived data
# (zone codes there are user ids: short numbers)
ODD_CODE_MIN_LENGTH = 2
ODD_CODE_EXCLUDED_PREFIX = "10"
SEARCH_TERM = "zone 1"
DEPARTMENT_LIST = ("20",)
ZONE_TYPE = "EPCI"
HISTORY_CODE = "7"
LOST_BETWEEN = ("2024-01-02", "2024-01-03")


def _on(fn: Callable[[Models], DataFrame], stored: bool = False) -> Query:
    """A query over new models of ``sf_dir``: each call derives what it needs from the tables.

    ``stored``: for queries that read staging several times, which then write it first.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(fn(Models.from_tables(spark, sf_dir, stored)))
    return run


def _model(name: str) -> Query:
    return _on(lambda m: getattr(m, name))


def _alerts(m: Models) -> DataFrame:
    return monitoring.gate_alerts(*m.monitors())


QUERIES: dict[str, Query] = {
    # models
    "air_staging": _model("stg_atmo_daily"),
    "weather_staging": _model("stg_meteo_daily"),
    "zone_profile": _model("mart_atmo_commune"),
    "daily_department": _model("mart_atmo_daily_departement"),
    "daily_national": _model("mart_atmo_daily_national"),
    "daily_with_weather": _model("mart_atmo_meteo_daily_departement"),
    # monitoring and quality
    "zone_coverage": _model("mon_commune_coverage"),
    "missing_departments": _model("mon_departement_manquant"),
    "missing_zones": _on(lambda m: monitoring.missing_zones(m.stg_atmo_daily, m.today)),
    "global_status": _on(lambda m: monitoring.global_status(*m.monitors())),
    "missing_department_table": _on(lambda m: monitoring.missing_department_table(m.mon_departement_manquant)),
    "gate_alerts": _on(lambda m: _alerts(m)),
    "gate_alerts_outage": _on(lambda m: _alerts(m.with_outage())),
    "missing_departments_outage": _on(lambda m: m.with_outage().mon_departement_manquant),
    "quality_report": _on(lambda m: quality.quality_report(m.tables()), stored=True),
    # anomalies
    "duplicate_zone_codes": _on(lambda m: A.duplicate_zone_codes(m.mart_atmo_commune)),
    "unnamed_zones": _on(lambda m: A.unnamed_zones(m.stg_atmo_daily)),
    "zones_lost": _on(lambda m: A.zones_lost(m.stg_atmo_daily, today=m.today), stored=True),
    "zones_lost_between": _on(lambda m: A.zones_lost(m.stg_atmo_daily, *LOST_BETWEEN), stored=True),
    "zone_history": _on(lambda m: A.zone_history(m.stg_atmo_daily, HISTORY_CODE)),
    "odd_codes": _on(lambda m: A.odd_codes(m.stg_atmo_daily, ODD_CODE_MIN_LENGTH, ODD_CODE_EXCLUDED_PREFIX)),
    "zones_of_type": _on(lambda m: A.zones_of_type(m.stg_atmo_daily, ZONE_TYPE)),
    "zones_in_departments": _on(lambda m: A.zones_in_departments(m.stg_atmo_daily, DEPARTMENT_LIST)),
    "index_ranges": _on(lambda m: A.index_ranges(m.stg_atmo_daily)),
    "department_centroids": _on(lambda m: A.department_centroids(m.stg_atmo_daily)),
    # rankings and selections
    "zone_selection": _on(lambda m: A.profile_selection(m.mart_atmo_commune)),
    "best_zones": _on(lambda m: A.best_zones(m.mart_atmo_commune)),
    "best_named_zones": _on(lambda m: A.ranked_named_zones(m.mart_atmo_commune, worst=False)),
    "worst_named_zones": _on(lambda m: A.ranked_named_zones(m.mart_atmo_commune, worst=True)),
    "search_zones": _on(lambda m: A.search_zones(m.mart_atmo_commune, SEARCH_TERM)),
    "national_selection": _on(lambda m: A.national_selection(m.mart_atmo_daily_national)),
    "department_selection": _on(lambda m: A.department_selection(m.mart_atmo_daily_departement)),
    "worst_departments_of_day": _on(lambda m: A.worst_departments_of_day(marts.daily_department(m.stg_today), m.today)),
    "mean_of_day": _on(lambda m: A.mean_of_day(marts.daily_department(m.stg_today), m.today)),
    "dominant_of_day": _on(lambda m: A.dominant_of_day(marts.daily_department(m.stg_today), m.today)),
    "headline": _on(lambda m: A.headline(marts.daily_national(m.stg_today))),
    "available_days": _on(lambda m: A.available_days(staging.days(m.raw_air))),
    # weather
    "weather_code_profile": _on(lambda m: A.weather_code_profile(m.mart_atmo_meteo_daily_departement)),
    "pm10_by_weather_code": _on(lambda m: A.weather_code_profile(m.mart_atmo_meteo_daily_departement, "PM10")),
    "index_band_weather": _on(lambda m: A.index_band_weather(m.mart_atmo_meteo_daily_departement)),
    "wind_band_index": _on(lambda m: A.wind_band_index(m.mart_atmo_meteo_daily_departement)),
    "temperature_band_o3": _on(lambda m: A.temperature_band_o3(m.mart_atmo_meteo_daily_departement)),
    "temperature_vs_index": _on(lambda m: A.temperature_vs_index(m.mart_atmo_meteo_daily_departement)),
}


# --- oracle ------------------------------------------------------------------------------

_ARRAYS = {
    "stg_atmo_daily": ["polluants_declencheurs"],
    "mart_atmo_commune": ["polluants_dominants"],
    "mart_atmo_daily_departement": ["polluants_dominants_departement"],
    "mart_atmo_daily_national": ["polluants_dominants_national"],
    "mart_atmo_meteo_daily_departement": ["polluants_dominants_departement"],
}


def _select_all(table: str) -> str:
    arrays = ", ".join(f"{O.arr(c)} AS {c}" for c in _ARRAYS.get(table, []))
    return O.with_models(f"SELECT * REPLACE ({arrays}) FROM {table}" if arrays else f"SELECT * FROM {table}")


def _sql_values(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _quality_sql() -> str:
    parts = []
    for r in quality.RULES:
        head = f"SELECT '{r.model}' AS model, '{r.column}' AS column_name, '{r.test}' AS test, '{r.severity}' AS severity"
        if r.test == "not_null":
            parts.append(f"{head}, count(*) FILTER (WHERE {r.column} IS NULL) AS failures FROM {r.model}")
        elif r.test == "accepted_values":
            parts.append(f"{head}, count(DISTINCT CASE WHEN {r.column} NOT IN ({_sql_values(r.values)}) "
                         f"THEN {r.column} END) AS failures FROM {r.model}")
        else:
            parts.append(f"{head}, count(*) AS failures FROM (SELECT {r.column} FROM {r.model} "
                         f"WHERE {r.column} IS NOT NULL GROUP BY {r.column} HAVING count(*) > 1)")
    union = "\nUNION ALL\n".join(parts)
    return O.with_models(f"""
SELECT model, column_name, test, severity, cast(failures AS bigint) AS failures,
  CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({union}) q""")


_MD = "mart_atmo_meteo_daily_departement"
_DEP_NEWEST = "(SELECT max(date_ech) FROM mart_atmo_daily_departement)"


def _band_desc(col, bands, other):
    return "CASE " + " ".join(f"WHEN {col} >= {b} THEN '{label}'" for label, b in bands) + f" ELSE '{other}' END"


def _band_asc(col, bands, other):
    return "CASE " + " ".join(f"WHEN {col} < {b} THEN '{label}'" for label, b in bands) + f" ELSE '{other}' END"


_WEATHER_MEANS = {"temp_max_moy": "temperature_max", "temp_min_moy": "temperature_min", "vent_moy": "wind_speed_max",
                  "precipitation_moy": "precipitation_sum"}


def _weather_by(key: str, *means: str, index: bool = True, only: str | None = None, extra: str | None = None) -> str:
    """Rows and rounded means of the weather join for each value of ``key``."""
    picked = [key, "count(*) AS nb_observations"]
    picked += ["round(avg(indice_moyen), 2) AS indice_moyen"] if index else []
    picked += [f"round(avg({_WEATHER_MEANS[m]}), 1) AS {m}" for m in means] + ([extra] if extra else [])
    where = f" WHERE list_contains(polluants_dominants_departement, '{only}')" if only else ""
    return O.with_models(f"SELECT {', '.join(picked)} FROM {_MD}{where} GROUP BY ALL")


def _with_outage(sql: str) -> str:
    """The query over readings of which the newest day holds a few zones only."""
    return sql.replace("  FROM raw_base\n),", f"""  FROM raw_base
  WHERE cast(ts AS date) < (SELECT max(cast(ts AS date)) FROM events) OR user_id % {fixtures.OUTAGE_KEEPS} = 0
),""")


ORACLE: dict[str, str] = {
    "air_staging": _select_all("stg_atmo_daily"),
    "weather_staging": _select_all("stg_meteo_daily"),
    "zone_profile": _select_all("mart_atmo_commune"),
    "daily_department": _select_all("mart_atmo_daily_departement"),
    "daily_national": _select_all("mart_atmo_daily_national"),
    "daily_with_weather": _select_all(_MD),
    "zone_coverage": _select_all("mon_commune_coverage"),
    "missing_departments": _select_all("mon_departement_manquant"),
    "missing_zones": O.with_models("SELECT code_insee, 'MANQUANT' AS statut FROM cov_missing"),
    "global_status": O.with_models("""
SELECT c.date_check, c.statut AS statut_couverture, d.statut_departements,
  CASE WHEN c.statut = 'CRITICAL' OR d.statut_departements = 'CRITICAL' THEN 'CRITICAL'
       WHEN c.statut = 'WARN' OR d.statut_departements = 'WARN' THEN 'WARN' ELSE 'OK' END AS statut_global,
  c.nb_communes_aujourd_hui, c.nb_communes_hier, c.nb_communes_manquantes,
  coalesce(d.nb_dep, 0)::bigint AS nb_departements_manquants
FROM mon_commune_coverage c,
     (SELECT max(statut_global) AS statut_departements, max(nb_departements_manquants) AS nb_dep
      FROM mon_departement_manquant) d"""),
    "missing_department_table": O.with_models("""
SELECT strftime(date_check, '%Y-%m-%d') AS date_check, code_departement, statut, statut_global
FROM mon_departement_manquant WHERE code_departement IS NOT NULL"""),
    "quality_report": _quality_sql(),
    "duplicate_zone_codes": O.with_models("""
SELECT * REPLACE (array_to_string(polluants_dominants, '|') AS polluants_dominants)
FROM mart_atmo_commune
WHERE code_insee IN (SELECT code_insee FROM mart_atmo_commune GROUP BY code_insee HAVING count(*) > 1)"""),
    "unnamed_zones": O.with_models("""
SELECT code_insee, nom_commune, count(*) AS nb_lignes FROM stg_atmo_daily
WHERE nom_commune IS NULL OR nom_commune = '' GROUP BY code_insee, nom_commune"""),
    "zones_lost": O.with_models("""
SELECT * REPLACE (array_to_string(polluants_declencheurs, '|') AS polluants_declencheurs)
FROM stg_atmo_daily s1
WHERE s1.date_ech < (SELECT max(date_ech) FROM stg_atmo_daily)
  AND NOT EXISTS (SELECT 1 FROM stg_atmo_daily s2
                  WHERE s2.date_ech = s1.date_ech + 1 AND s2.code_insee = s1.code_insee)"""),
    "zones_lost_between": O.with_models(f"""
SELECT * REPLACE (array_to_string(polluants_declencheurs, '|') AS polluants_declencheurs) FROM stg_atmo_daily
WHERE date_ech = DATE '{LOST_BETWEEN[0]}' AND (code_insee IS NULL OR code_insee NOT IN (
  SELECT code_insee FROM stg_atmo_daily WHERE date_ech = DATE '{LOST_BETWEEN[1]}' AND code_insee IS NOT NULL))"""),
    "zone_history": O.with_models(f"""
SELECT * REPLACE (array_to_string(polluants_declencheurs, '|') AS polluants_declencheurs) FROM stg_atmo_daily
WHERE code_insee = '{HISTORY_CODE}'"""),
    "gate_alerts": O.with_models("""
SELECT 'zone coverage' AS moniteur, statut, nb_communes_manquantes::bigint AS nb_manquants,
       nb_communes_hier::bigint AS nb_reference
FROM mon_commune_coverage WHERE statut = 'CRITICAL'
UNION ALL
SELECT DISTINCT 'missing départements', statut_global, nb_departements_manquants::bigint, NULL::bigint
FROM mon_departement_manquant WHERE statut_global = 'CRITICAL'"""),
    "odd_codes": O.with_models(f"""
SELECT DISTINCT code_insee, nom_commune, left(cast(code_insee AS varchar), 2) AS debut
FROM stg_atmo_daily
WHERE length(cast(code_insee AS varchar)) > {ODD_CODE_MIN_LENGTH}
  AND left(cast(code_insee AS varchar), {len(ODD_CODE_EXCLUDED_PREFIX)}) != '{ODD_CODE_EXCLUDED_PREFIX}'
ORDER BY code_insee, nom_commune NULLS LAST
LIMIT 20"""),
    "zones_of_type": O.with_models(f"""
SELECT * REPLACE (array_to_string(polluants_declencheurs, '|') AS polluants_declencheurs)
FROM stg_atmo_daily WHERE type_zone = '{ZONE_TYPE}'"""),
    "zones_in_departments": O.with_models(f"""
SELECT * REPLACE (array_to_string(polluants_declencheurs, '|') AS polluants_declencheurs)
FROM stg_atmo_daily WHERE code_departement IN ({_sql_values(DEPARTMENT_LIST)})"""),
    "index_ranges": O.with_models(f"""
SELECT {', '.join(f"{fn}({c}) AS {fn}_{c.removeprefix('code_')}" for c in K.SUB_INDEX_COLUMNS for fn in ('min', 'max'))}
FROM stg_atmo_daily"""),
    "department_centroids": O.with_models("""
SELECT code_departement, round(avg(longitude), 4) AS lon, round(avg(latitude), 4) AS lat
FROM stg_atmo_daily WHERE longitude IS NOT NULL AND latitude IS NOT NULL GROUP BY code_departement"""),
    "zone_selection": O.with_models("""
SELECT code_insee, nom_commune, code_departement, indice_moyen, pct_jours_acceptable,
  array_to_string(polluants_dominants, '|') AS polluants_dominants, nb_jours_mesures, premiere_date,
  derniere_date, indice_moyen_no2, indice_moyen_o3, indice_moyen_pm10, indice_moyen_pm25, indice_moyen_so2
FROM mart_atmo_commune WHERE nb_jours_mesures >= 2"""),
    "best_zones": O.with_models("""
SELECT code_insee, nom_commune, nb_jours_mesures, indice_moyen, pct_jours_acceptable
FROM mart_atmo_commune WHERE nb_jours_mesures >= 7
ORDER BY indice_moyen ASC NULLS LAST, code_insee, nom_commune NULLS LAST, code_departement NULLS LAST
LIMIT 20"""),
    "best_named_zones": O.with_models("""
SELECT nom_commune, code_departement, indice_moyen, pct_jours_acceptable, code_insee
FROM mart_atmo_commune
WHERE nb_jours_mesures >= 2 AND nom_commune IS NOT NULL AND indice_moyen IS NOT NULL
ORDER BY indice_moyen ASC, code_insee, nom_commune, code_departement NULLS LAST
LIMIT 15"""),
    "worst_named_zones": O.with_models("""
SELECT nom_commune, code_departement, indice_moyen, pct_jours_acceptable, code_insee
FROM mart_atmo_commune
WHERE nb_jours_mesures >= 2 AND nom_commune IS NOT NULL AND indice_moyen IS NOT NULL
ORDER BY indice_moyen DESC, code_insee, nom_commune, code_departement NULLS LAST
LIMIT 15"""),
    "search_zones": O.with_models(f"""
SELECT nom_commune, code_insee, code_departement, indice_moyen, pct_jours_acceptable,
  indice_moyen_no2, indice_moyen_o3, indice_moyen_pm10, indice_moyen_pm25
FROM mart_atmo_commune
WHERE nb_jours_mesures >= 2
  AND (coalesce(regexp_matches(lower(nom_commune), '{SEARCH_TERM.lower()}'), false)
       OR coalesce(regexp_matches(cast(code_insee AS varchar), '{SEARCH_TERM}'), false))"""),
    "national_selection": O.with_models("""
SELECT date_ech, indice_moyen_national, nb_communes, nb_bon, nb_mauvais_ou_pire,
  array_to_string(polluants_dominants_national, '|') AS polluants_dominants_national
FROM mart_atmo_daily_national"""),
    "department_selection": O.with_models("""
SELECT date_ech, code_departement, indice_moyen, nb_communes,
  array_to_string(polluants_dominants_departement, '|') AS polluants_dominants_departement,
  pct_no2_declencheur, pct_o3_declencheur, pct_pm10_declencheur, pct_pm25_declencheur, pct_so2_declencheur
FROM mart_atmo_daily_departement"""),
    "worst_departments_of_day": O.with_models(f"""
SELECT date_ech, code_departement, indice_moyen, nb_communes FROM mart_atmo_daily_departement
WHERE date_ech = {_DEP_NEWEST}
ORDER BY indice_moyen DESC NULLS LAST, code_departement NULLS LAST LIMIT 5"""),
    "mean_of_day": O.with_models(f"""
SELECT date_ech, round(avg(indice_moyen), 2) AS indice_jour, count(*) AS nb_departements
FROM mart_atmo_daily_departement WHERE date_ech = {_DEP_NEWEST} GROUP BY date_ech"""),
    "dominant_of_day": O.with_models(f"""
SELECT date_ech, polluant, count(*) AS nb
FROM (SELECT date_ech, unnest(polluants_dominants_departement) AS polluant
      FROM mart_atmo_daily_departement WHERE date_ech = {_DEP_NEWEST})
GROUP BY date_ech, polluant ORDER BY nb DESC, polluant ASC LIMIT 1"""),
    "headline": O.with_models("""
SELECT date_ech, indice_moyen_national, nb_communes, nb_bon, nb_mauvais_ou_pire,
  CASE WHEN nb_communes > 0 THEN round(100.0 * nb_bon / nb_communes, 1) ELSE 0.0 END::double AS pct_bon
FROM mart_atmo_daily_national ORDER BY date_ech DESC NULLS LAST LIMIT 1"""),
    "available_days": O.with_models("""
SELECT DISTINCT date_ech, strftime(date_ech, '%Y-%m-%d') AS jour, strftime(date_ech, '%m-%d') AS mois_jour
FROM mart_atmo_daily_departement"""),
    "weather_code_profile": _weather_by("weathercode", "temp_max_moy", "vent_moy"),
    "pm10_by_weather_code": _weather_by("weathercode", "vent_moy", "precipitation_moy", only="PM10"),
    "index_band_weather": _weather_by(
        _band_desc("indice_moyen", K.INDEX_BANDS, K.INDEX_BAND_ELSE) + " AS qualite",
        "temp_max_moy", "temp_min_moy", "vent_moy", "precipitation_moy", index=False),
    "wind_band_index": _weather_by(_band_asc("wind_speed_max", K.WIND_BANDS, K.WIND_BAND_ELSE) + " AS categorie_vent"),
    "temperature_band_o3": _weather_by(
        _band_asc("temperature_max", K.TEMPERATURE_BANDS, K.TEMPERATURE_BAND_ELSE) + " AS categorie_temp",
        extra="sum(list_contains(polluants_dominants_departement, 'O3')::int)::bigint AS nb_fois_o3_dominant"),
    "temperature_vs_index": O.with_models(f"""
SELECT *, strftime(date_ech, '%m-%d') AS mois_jour FROM (
  SELECT date_ech, round(avg(temperature_max), 1) AS temperature_max, round(avg(indice_moyen), 2) AS indice_moyen
  FROM (SELECT * FROM {_MD} WHERE temperature_max IS NOT NULL) GROUP BY ALL)"""),
}


# --- sources, sinks, rebuild, SQL console --------------------------------------------------
# These write to fresh folders under ``spark.checkpoint.dir`` and read the result back.


LANDING_SCHEMA = T.StructType(RAW_AIR.fields + [T.StructField("drop", T.IntegerType())])

# a store that already holds every day older than the newest week
STORED_BEFORE_DAYS = 7
USER_SQL = """
SELECT code_departement, count(*) AS nb_jours, max(indice_moyen) AS indice_max,
       CAST(sum(nb_communes) AS BIGINT) AS nb_lignes
FROM mart_atmo_daily_departement
GROUP BY code_departement;"""


def _raw_air_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if c == "date_ech" else F.col(c) for c in RAW_AIR.fieldNames()])


def _flatten_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = fixtures.raw_weather(fixtures.table(spark, sf_dir, "orders"))
    return payload.flatten_series(fixtures.weather_payload(weather), fixtures.centroids(weather))


def _older_days(raw: DataFrame) -> DataFrame:
    newest = raw.select(F.max(F.col("date_ech").cast("date"))).scalar()
    return raw.filter(F.col("date_ech").cast("date") < F.date_sub(newest, STORED_BEFORE_DAYS))


def _new_days_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_readings(fixtures.table(spark, sf_dir, "events"))
    root = fresh_path(spark, "store-air")
    ingest.ingest_days(spark, _older_days(raw), root)
    return ingest.plan_days(raw, ingest.stored_days(spark, root))


def _parquet_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_readings(fixtures.table(spark, sf_dir, "events"))
    root = fresh_path(spark, "store-air")
    ingest.ingest_days(spark, _older_days(raw), root)   # first run: older days
    ingest.ingest_days(spark, raw, root)                # second run: only the newest week is added
    return _raw_air_columns(ingest.read_store(spark, root))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_readings(fixtures.table(spark, sf_dir, "events"))
    path = fresh_path(spark, "csv-air")
    raw.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return _raw_air_columns(ingest.read_raw_csv(spark, path, expected_columns=len(raw.columns)))


def _json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = fixtures.raw_weather(fixtures.table(spark, sf_dir, "orders"))
    path = fresh_path(spark, "json-weather")
    ingest.write_json(weather, path)
    return ingest.read_json(spark, path, RAW_WEATHER)


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_readings(fixtures.table(spark, sf_dir, "events")).select(*RAW_AIR.fieldNames())
    landing, store, ckpt = (fresh_path(spark, n) for n in ("landing", "store-air", "stream-ckpt"))
    older = _older_days(raw)
    older.write.mode("overwrite").partitionBy("date_ech").parquet(landing + "/drop=1")
    stream_ingest(spark, landing, store, ckpt, LANDING_SCHEMA)
    raw.join(older.select("date_ech").distinct(), "date_ech", "left_anti") \
        .write.mode("overwrite").partitionBy("date_ech").parquet(landing + "/drop=2")
    stream_ingest(spark, landing, store, ckpt, LANDING_SCHEMA)  # a re-run takes only the new files
    return _raw_air_columns(ingest.read_store(spark, store))


def _user_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models.from_tables(spark, sf_dir)
    sqlapi.publish({name: getattr(m, name) for name in sqlapi.PUBLISHED_VIEWS})
    return sqlapi.read_only_sql(spark, USER_SQL)


def _rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = fixtures.Inputs.load(spark, sf_dir)
    air_root, weather_root = fresh_path(spark, "store-air"), fresh_path(spark, "store-weather")
    ingest.ingest_days(spark, i.raw_air, air_root)
    ingest.ingest_days(spark, i.raw_weather, weather_root)
    tables = rebuild.run_all(spark, air_root, weather_root, i.communes, i.epci, fresh_path(spark, "rebuild"),
                              fixtures.FIXTURE_ZONE_OVERRIDES, gate=False)
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(name).alias("table_name"), "nb_lignes")
        out = part if out is None else out.unionByName(part)
    return out


def _rebuild_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone profiles that a full rebuild from the two stores leaves."""
    i = fixtures.Inputs.load(spark, sf_dir)
    air_root, weather_root = fresh_path(spark, "store-air"), fresh_path(spark, "store-weather")
    ingest.ingest_days(spark, i.raw_air, air_root)
    ingest.ingest_days(spark, i.raw_weather, weather_root)
    return flat(rebuild.run_all(spark, air_root, weather_root, i.communes, i.epci, fresh_path(spark, "rebuild"),
                                fixtures.FIXTURE_ZONE_OVERRIDES, gate=False)["mart_atmo_commune"])


def _rebuild_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days but the newest week built in full, then that week ingested and its days built in one pass."""
    i = fixtures.Inputs.load(spark, sf_dir)
    air_root, out = fresh_path(spark, "store-air"), fresh_path(spark, "rebuild-day")
    ingest.ingest_days(spark, _older_days(i.raw_air), air_root)
    rebuild.run_all(spark, air_root, None, i.communes, i.epci, out, fixtures.FIXTURE_ZONE_OVERRIDES, gate=False)
    ingest.ingest_days(spark, i.raw_air, air_root)
    tables = rebuild.run_missing(spark, air_root, None, i.communes, i.epci, out, fixtures.FIXTURE_ZONE_OVERRIDES, gate=False)
    return flat(tables["mart_atmo_daily_departement"])


def _rebuild_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything built with older reference tables, then only the days that hold a zone whose département changed."""
    i = fixtures.Inputs.load(spark, sf_dir)
    air_root, out = fresh_path(spark, "store-air"), fresh_path(spark, "rebuild-references")
    ingest.ingest_days(spark, i.raw_air, air_root)
    rebuild.run_all(spark, air_root, None, fixtures.former_communes(i.communes), i.epci, out,
                    fixtures.FIXTURE_ZONE_OVERRIDES, gate=False)
    tables = rebuild.run_references(spark, air_root, None, i.communes, i.epci, out, fixtures.FIXTURE_ZONE_OVERRIDES,
                                    gate=False)
    return flat(tables["mart_atmo_daily_departement"])


def _daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run of the newest day, told by its day and paths: the day's file, the store, the tables."""
    i = fixtures.Inputs.load(spark, sf_dir)
    csv, air_root, out = (fresh_path(spark, n) for n in ("csv-air", "store-air", "daily-run"))
    i.raw_air.write.mode("overwrite").option("header", True).option("escape", '"').csv(csv)
    day = i.raw_air.agg(F.max("date_ech")).first()[0]
    daily_air_run(spark, csv, day, air_root, i.communes, i.epci, out, overrides=fixtures.FIXTURE_ZONE_OVERRIDES,
                  expected_columns=len(i.raw_air.columns))
    return flat(open_table(spark, f"{out}/mart_atmo_daily_national"))


def _ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the daily ingest says of one file: wrong column count, a day without rows, a new day, a stored day."""
    raw = fixtures.raw_readings(fixtures.table(spark, sf_dir, "events"))
    path, root = fresh_path(spark, "csv-air"), fresh_path(spark, "store-air")
    raw.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    day = raw.agg(F.max("date_ech")).first()[0]
    out = []
    for name, when, columns in (("header", day, K.RAW_AIR_COLUMN_COUNT), ("no_row", "1900-01-01", len(raw.columns)),
                                ("new_day", day, len(raw.columns)), ("stored_day", day, len(raw.columns))):
        try:
            r = ingest.ingest_day(spark, path, root, when, columns)
            out.append((name, r["status"], r["rows"]))
        except (ingest.SchemaError, ingest.EmptyDayError) as e:
            out.append((name, type(e).__name__, None))
    return spark.createDataFrame(out, "verification string, statut string, nb_lignes long")


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings exported as CSV, names with quotes and commas, and read back."""
    raw = fixtures.raw_readings(fixtures.table(spark, sf_dir, "events"))
    path = fresh_path(spark, "csv-export")
    ingest.export_csv(raw.select("event_id", F.concat(F.lit('L "'), "lib_zone", F.lit('", nord')).alias("nom")), path)
    return ingest.read_csv_text(spark, path).select(F.col("event_id").cast("long").alias("event_id"), "nom")


def _centroid_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations numbered by their place in the file (one row per département)."""
    weather = fixtures.raw_weather(fixtures.table(spark, sf_dir, "orders"))
    path = fresh_path(spark, "centroids")
    (fixtures.centroids(weather).select("code_departement", "lon", "lat").orderBy(F.desc("code_departement"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))
    return ingest.read_centroids(spark, path)


QUERIES.update({
    "daily_run": _daily_run,
    "rebuild_day": _rebuild_day,
    "rebuild_references": _rebuild_references,
    "rebuild_values": _rebuild_values,
    "ingest_outcomes": _ingest_outcomes,
    "csv_export": _csv_export,
    "centroid_positions": _centroid_positions,
    "flatten_series": _flatten_series,
    "new_days_only": _new_days_only,
    "parquet_by_day": _parquet_by_day,
    "csv_round_trip": _csv_round_trip,
    "json_round_trip": _json_round_trip,
    "stream_ingest": _stream_ingest,
    "user_sql": _user_sql,
    "rebuild": _rebuild,
})

_RAW_AIR_SELECT = "SELECT " + ", ".join(RAW_AIR.fieldNames()) + " FROM raw_air_l"
_OLDER = (f"cast(date_ech AS date) < (SELECT max(cast(date_ech AS date)) FROM raw_air_l) "
          f"- INTERVAL {STORED_BEFORE_DAYS} DAY")

ORACLE.update({
    "gate_alerts_outage": _with_outage(ORACLE["gate_alerts"]),
    "missing_departments_outage": _with_outage(ORACLE["missing_departments"]),
    "daily_run": _select_all("mart_atmo_daily_national") + " WHERE date_ech = (SELECT max(date_ech) FROM stg_atmo_daily)",
    "rebuild_day": _select_all("mart_atmo_daily_departement"),
    "rebuild_references": _select_all("mart_atmo_daily_departement"),
    "rebuild_values": _select_all("mart_atmo_commune"),
    "ingest_outcomes": O.with_models("""
SELECT * FROM (VALUES ('header', 'SchemaError', NULL), ('no_row', 'EmptyDayError', NULL), ('stored_day', 'skipped', NULL))
  v(verification, statut, nb_lignes)
UNION ALL
SELECT 'new_day', 'saved', count(*)::bigint FROM raw_air_l WHERE date_ech = (SELECT max(date_ech) FROM raw_air_l)"""),
    "csv_export": O.with_models("""SELECT event_id, 'L "' || lib_zone || '", nord' AS nom FROM raw_air_l"""),
    "centroid_positions": O.with_models("""
SELECT (row_number() OVER (ORDER BY code_departement DESC) - 1)::integer AS location_id, code_departement,
       longitude AS lon, latitude AS lat
FROM (SELECT DISTINCT code_departement, longitude, latitude FROM raw_weather)"""),
    "flatten_series": O.with_models("""
, chunks AS (
  SELECT cast(code_departement AS integer) AS location_id, date_trunc('month', cast(date_ech AS date)) AS m,
         min(cast(date_ech AS date)) AS lo, max(cast(date_ech AS date)) AS hi
  FROM raw_weather GROUP BY 1, 2
), days AS (
  SELECT location_id, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS d FROM chunks
), locs AS (
  SELECT DISTINCT cast(code_departement AS integer) AS location_id, code_departement, longitude, latitude
  FROM raw_weather
)
SELECT strftime(days.d, '%Y-%m-%d') AS date_ech, l.code_departement, l.latitude, l.longitude,
  w.temperature_mean, w.temperature_max, w.temperature_min, w.rain_sum, w.wind_speed_max,
  w.precipitation_sum, w.weathercode
FROM days
LEFT JOIN raw_weather w ON cast(w.code_departement AS integer) = days.location_id
                       AND cast(w.date_ech AS date) = days.d
LEFT JOIN locs l ON l.location_id = days.location_id"""),
    "new_days_only": O.with_models(f"""
SELECT date_ech, count(*) AS nb_lignes,
  CASE WHEN {_OLDER} THEN 'skipped' ELSE 'saved' END AS action
FROM raw_air_l GROUP BY date_ech"""),
    "parquet_by_day": O.with_models(_RAW_AIR_SELECT),
    "csv_round_trip": O.with_models(_RAW_AIR_SELECT),
    "json_round_trip": O.with_models("SELECT * FROM raw_weather"),
    "stream_ingest": O.with_models(_RAW_AIR_SELECT),
    "user_sql": O.with_models(USER_SQL.strip().rstrip(";")),
    "rebuild": O.with_models("""
SELECT 'stg_atmo_daily' AS table_name, count(*) AS nb_lignes FROM stg_atmo_daily
UNION ALL SELECT 'stg_meteo_daily', count(*) FROM stg_meteo_daily
UNION ALL SELECT 'mart_atmo_commune', count(*) FROM mart_atmo_commune
UNION ALL SELECT 'mart_atmo_daily_national', count(*) FROM mart_atmo_daily_national
UNION ALL SELECT 'mart_atmo_daily_departement', count(*) FROM mart_atmo_daily_departement
UNION ALL SELECT 'mart_atmo_meteo_daily_departement', count(*) FROM mart_atmo_meteo_daily_departement
UNION ALL SELECT 'mon_commune_coverage', count(*) FROM mon_commune_coverage
UNION ALL SELECT 'mon_departement_manquant', count(*) FROM mon_departement_manquant
UNION ALL SELECT 'quality_report', """ + str(len(quality.RULES))),
})
