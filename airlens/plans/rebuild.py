"""Rebuilds of the published tables, in dependency order.

``run_all`` recomputes every table from every stored day (the full refresh). ``run_days`` recomputes a set of days in one pass: staging and the daily marts are kept by day,
so the rows of these days depend on their raw rows only; each table gets them by one job and one commit. What
covers the whole period is kept in parts that add up: sums per zone and month (``zone_month_sums``), from
which the zone profile is merged, and the findings of the quality rules per day (``quality_findings``). A
new day adds its sums to its month; a month one of whose days was replaced is summed again from its staging. So a daily
run reads the raw rows and staging of its days, the parts, and the two days the monitors compare.

The sums remember which files of staging each month came from, and the last step of a run notes from which raw files it
built each day (``built_days``). So ``run_missing`` finds what is left to do, whatever happened before: new days, days
that were replaced or gained files, and days of a run that died between two commits.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.operators import marts, monitoring, quality, staging
from airlens.plans.sqlapi import publish
from airlens.sources import manifest
from airlens.sources.ingest import read_store
from airlens.sources.schemas import RAW_AIR, RAW_WEATHER
from airlens.sources.store import open_table, save_days, save_whole

# tables kept by day
BY_DAY = ("stg_atmo_daily", "stg_meteo_daily", "mart_atmo_daily_departement", "mart_atmo_daily_national",
          "mart_atmo_meteo_daily_departement")
# what staging resolves each named zone to
ZONES = "zone_departments"
# kept parts: sums per zone and month, findings per day; and from which raw files each day was built
SUMS, FINDINGS, BUILT = "zone_month_sums", "quality_findings", "built_days"


def _path(out_root: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/{name}"


def _save(df: DataFrame, out_root: str, name: str, days: Iterable[str] | None = None) -> DataFrame:
    """Replace a table, or make ``df`` the whole content of ``days`` (a day without rows goes); read it back."""
    path = _path(out_root, name)
    return save_days(df, path, days) if name in BY_DAY else save_whole(df, path)


def _of_days(t: DataFrame, spark: SparkSession, out_root: str, name: str, days: Iterable[str] | None) -> DataFrame:
    """The stored rows of ``days`` alone: only their folders are opened."""
    return t if days is None else manifest.read(spark, _path(out_root, name), t.schema, days)


def _last_two(t: DataFrame, spark: SparkSession, out_root: str, name: str) -> tuple[DataFrame, F.Column]:
    """The rows that a monitor compares, and the newest stored day (null if there is none)."""
    state = manifest.snapshot(spark, _path(out_root, name))
    newest = state.day_list()[-2:]     # the day before, if stored, is among them
    return (manifest.read(spark, state.root, t.schema, newest, at=state),
            F.lit(newest[-1] if newest else None).cast("date"))


def _month(day: str) -> str:
    return day if day == manifest.NO_DAY else day[:7]


def _refresh_sums(stg: DataFrame, out_root: str) -> DataFrame:
    """Bring the sums per zone and month up to the stored staging; returns them all.

    A month whose staging only gained days gets their sums added; any other difference (a day replaced or gone) sums
    the month's staging again.
    """
    spark, root = stg.sparkSession, _path(out_root, SUMS)
    source, kept = manifest.snapshot(spark, _path(out_root, "stg_atmo_daily")), manifest.snapshot(spark, root)
    wanted: dict[str, dict] = {}
    for day, entry in source.days.items():
        wanted.setdefault(_month(day), {})[day] = entry["folders"]
    summed = {month: entry["of"] for month, entry in kept.days.items()}
    changed = [m for m in wanted.keys() | summed.keys() if wanted.get(m) != summed.get(m)]
    grown = [m for m in changed if m in summed and all(wanted.get(m, {}).get(d) == f for d, f in summed[m].items())]
    days = [d for m in changed if m in wanted for d in wanted[m] if not (m in grown and d in summed[m])]
    month = F.coalesce(F.date_format("date_ech", "yyyy-MM"), F.lit(manifest.NO_DAY)).alias("mois")
    sums = marts.profile_sums(manifest.read(spark, source.root, stg.schema, days, at=source), month)
    if grown:
        sums = marts.merge_sums(sums.unionByName(manifest.read(spark, root, sums.schema, grown, at=kept)), "mois")
    if changed:
        kept = manifest.replace_days(sums.hint("rebalance", "mois"), root, changed, "mois", wanted)
    return manifest.read(spark, root, sums.schema, at=kept)


def _findings(t: Mapping[str, DataFrame], spark: SparkSession, out_root: str, days: Iterable[str] | None) -> DataFrame:
    """Findings of the rules on the tables kept by day: those of ``days`` are found again, all are returned."""
    found = None
    for name in BY_DAY:
        rules = quality.rules_of(name)
        if name in t and rules:
            part = quality.broken_values(_of_days(t[name], spark, out_root, name, days), rules, "date_ech")
            found = part if found is None else found.unionByName(part)
    return save_days(found, _path(out_root, FINDINGS), days).drop("date_ech")


def _raw_files(spark: SparkSession, raw_air: str, raw_weather: str | None) -> dict[str, dict]:
    """For each raw day the folders that hold it."""
    out: dict[str, dict] = {}
    for kind, root in (("air", raw_air), ("weather", raw_weather)):
        for day, entry in (manifest.snapshot(spark, root).days if isinstance(root, str) else {}).items():
            out.setdefault(day, {})[kind] = entry["folders"]
    return out


def _note_built(spark: SparkSession, out_root: str, raw: Mapping[str, dict], days: Iterable[str] | None) -> None:
    base = manifest.snapshot(spark, _path(out_root, BUILT))
    days = base.days.keys() | raw.keys() if days is None else set(days)
    noted = {d: {"folders": [], "rows": 0, "of": raw[d]} for d in days if d in raw}
    manifest.publish(spark, base, {d: e for d, e in base.days.items() if d not in days} | noted)


def _finish(t: dict[str, DataFrame], spark: SparkSession, out_root: str, gate: bool,
            days: Iterable[str] | None, raw: Mapping[str, dict]) -> dict[str, DataFrame]:
    """Monitors and quality report over the stored tables, views, the note of what is built, then the gate."""
    rows, today = _last_two(t["stg_atmo_daily"], spark, out_root, "stg_atmo_daily")
    t["mon_commune_coverage"] = _save(monitoring.zone_coverage(rows, today), out_root, "mon_commune_coverage")
    name = "mart_atmo_daily_departement"
    rows, today = _last_two(t[name], spark, out_root, name)
    t["mon_departement_manquant"] = _save(monitoring.missing_departments(rows, today), out_root, "mon_departement_manquant")
    found = _findings(t, spark, out_root, days)
    for name in t:
        rules = [] if name in BY_DAY else quality.rules_of(name)
        if rules:
            found = found.unionByName(quality.broken_values(t[name], rules))
    rules = [r for name in t for r in quality.rules_of(name)]
    t["quality_report"] = _save(quality.report_of(found, rules), out_root, "quality_report")
    publish(t)
    _note_built(spark, out_root, raw, days)
    if gate:
        monitoring.gate(t["mon_commune_coverage"], t["mon_departement_manquant"])
    return t


def _build(spark: SparkSession, air: DataFrame, weather: DataFrame | None, communes: DataFrame, epci: DataFrame,
           out_root: str, overrides: Mapping[str, str], gate: bool, days: list[str] | None,
           raw: Mapping[str, dict]) -> dict[str, DataFrame]:
    """Every table from the raw rows of ``days`` (``None``: of all days), each by one job and one commit."""
    def save(df: DataFrame, name: str) -> DataFrame:
        t[name] = _save(df, out_root, name, days)
        return _of_days(t[name], spark, out_root, name, days)

    t: dict[str, DataFrame] = {}
    stg = save(staging.air_staging(air, communes, epci, overrides), "stg_atmo_daily")
    meteo = None if weather is None else save(staging.weather_staging(weather), "stg_meteo_daily")
    t["mart_atmo_commune"] = _save(
        marts.profile_of_sums(marts.merge_sums(_refresh_sums(t["stg_atmo_daily"], out_root))), out_root, "mart_atmo_commune")
    save(marts.daily_national(stg), "mart_atmo_daily_national")
    department = save(marts.daily_department(stg), "mart_atmo_daily_departement")
    if meteo is not None:
        save(marts.daily_with_weather(department, meteo), "mart_atmo_meteo_daily_departement")
    return _finish(t, spark, out_root, gate, days, raw)


def run_all(spark: SparkSession, raw_air: DataFrame | str, raw_weather: DataFrame | str | None,
            communes: DataFrame, epci: DataFrame, out_root: str,
            overrides: Mapping[str, str] = K.ZONE_OVERRIDES, gate: bool = True) -> dict[str, DataFrame]:
    """Rebuild every table from all stored days and return them (read back from storage).

    Each table is written once and later steps read the written table, so no
    step recomputes an earlier one and a lost executor re-reads files. The
    monitors run last; with ``gate`` a CRITICAL monitor raises
    :class:`~airlens.operators.monitoring.MonitoringAlert` after everything is written.
    """
    raw = _raw_files(spark, raw_air, raw_weather)    # before the rows are read: what comes later counts as not built
    air = read_store(spark, raw_air, RAW_AIR) if isinstance(raw_air, str) else raw_air
    weather = read_store(spark, raw_weather, RAW_WEATHER) if isinstance(raw_weather, str) else raw_weather
    save_whole(staging.zone_departments(communes, epci, overrides), _path(out_root, ZONES))
    return _build(spark, air, weather, communes, epci, out_root, overrides, gate, None, raw)


def run_days(spark: SparkSession, days: Iterable[str], raw_air: str, raw_weather: str | None,
             communes: DataFrame, epci: DataFrame, out_root: str,
             overrides: Mapping[str, str] = K.ZONE_OVERRIDES, gate: bool = True) -> dict[str, DataFrame]:
    """Rebuild after some days were ingested or replaced: same tables as :func:`run_all`, by one pass over these days.

    Requires the other days to have been built with the same reference tables (else :func:`run_references`).
    """
    days, raw = sorted(set(days)), _raw_files(spark, raw_air, raw_weather)
    air = read_store(spark, raw_air, RAW_AIR, days)
    weather = None if raw_weather is None else read_store(spark, raw_weather, RAW_WEATHER, days)
    return _build(spark, air, weather, communes, epci, out_root, overrides, gate, days, raw)


def run_day(spark: SparkSession, day: str, raw_air: str, raw_weather: str | None,
            communes: DataFrame, epci: DataFrame, out_root: str,
            overrides: Mapping[str, str] = K.ZONE_OVERRIDES, gate: bool = True) -> dict[str, DataFrame]:
    """:func:`run_days` of one day."""
    return run_days(spark, [day], raw_air, raw_weather, communes, epci, out_root, overrides, gate)


def days_to_build(spark: SparkSession, raw_air: str, raw_weather: str | None, out_root: str) -> list[str]:
    """Days whose raw files are not those they were built from (or that were not built, or are gone)."""
    raw, built = _raw_files(spark, raw_air, raw_weather), manifest.snapshot(spark, _path(out_root, BUILT)).days
    return sorted(d for d in raw.keys() | built.keys() if raw.get(d) != built.get(d, {}).get("of"))


def run_missing(spark: SparkSession, raw_air: str, raw_weather: str | None, communes: DataFrame, epci: DataFrame,
                out_root: str, overrides: Mapping[str, str] = K.ZONE_OVERRIDES, gate: bool = True) -> dict[str, DataFrame]:
    """:func:`run_days` of all :func:`days_to_build`."""
    return run_days(spark, days_to_build(spark, raw_air, raw_weather, out_root), raw_air, raw_weather, communes, epci,
                    out_root, overrides, gate)


def run_references(spark: SparkSession, raw_air: str, raw_weather: str | None, communes: DataFrame, epci: DataFrame,
                   out_root: str, overrides: Mapping[str, str] = K.ZONE_OVERRIDES, gate: bool = True) -> dict[str, DataFrame]:
    """Rebuild after the reference tables or the overrides changed: only days that hold a zone that resolves to another
    département now (one scan of two raw columns finds them), and those of :func:`days_to_build`.

    The new resolution is noted after the days are built, so a run that dies is repeated.
    """
    after = staging.zone_departments(communes, epci, overrides)
    changed = staging.changed_zones(open_table(spark, _path(out_root, ZONES)), after)
    touched = read_store(spark, raw_air, RAW_AIR).select("date_ech", "code_zone").join(changed, "code_zone", "left_semi")
    days = [r[0] for r in touched.select("date_ech").distinct().collect()]      # one row for each day
    t = run_days(spark, {*days, *days_to_build(spark, raw_air, raw_weather, out_root)}, raw_air, raw_weather, communes, epci,
                 out_root, overrides, gate=False)
    save_whole(after, _path(out_root, ZONES))
    if gate:
        monitoring.gate(t["mon_commune_coverage"], t["mon_departement_manquant"])
    return t


def rebuild_weather(spark: SparkSession, raw_weather: DataFrame | str, out_root: str,
                    day: str | None = None) -> dict[str, DataFrame]:
    """Weather staging and its join with the stored daily département mart, as it is now.

    With ``day``, only that day's weather rows are read and only that day is replaced in both tables.
    """
    days = None if day is None else [day]
    weather = read_store(spark, raw_weather, RAW_WEATHER, days) if isinstance(raw_weather, str) else raw_weather
    if day is not None:
        weather = weather.filter(F.col("date_ech").cast("string") == day)
    names = ("stg_meteo_daily", "mart_atmo_meteo_daily_departement")
    dep = open_table(spark, _path(out_root, "mart_atmo_daily_departement"))
    if day is not None:
        dep = dep.filter(F.col("date_ech") == F.lit(day).cast("date"))
    t = {names[0]: _save(staging.weather_staging(weather), out_root, names[0], days)}
    meteo = _of_days(t[names[0]], spark, out_root, names[0], days)
    t[names[1]] = _save(marts.daily_with_weather(dep, meteo), out_root, names[1], days)
    return t
