"""Day-over-day monitoring: zone coverage, missing départements, global status, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.functions.expr import coverage_status, departments_status, worst_status


def _look_back(df: DataFrame, today):
    """The newest day and the calendar day before it.

    ``today`` comes from the caller, who knows it from the partitions of a stored table
    or from the raw rows; without it the newest day is the maximum over all rows of ``df``.
    """
    if today is None:
        today = df.select(F.max("date_ech")).scalar()
    elif not isinstance(today, F.Column):
        today = F.lit(today).cast("date")
    return today, F.date_sub(today, 1)


def zone_coverage(stg: DataFrame, today=None) -> DataFrame:
    """``mon_commune_coverage``: rows today, rows yesterday, yesterday's rows whose code is absent today.

    One pass over the two days: a per-code aggregate (partial on each task,
    shuffled on the code) and a global sum. "Yesterday" is the newest day minus
    one calendar day; if it has no rows nothing is missing.
    """
    today, yesterday = _look_back(stg, today)
    day = F.col("date_ech")
    per_code = (stg.filter((day == today) | (day == yesterday))
                .groupBy("code_insee")
                .agg(F.count_if(day == today).alias("t"), F.count_if(day == yesterday).alias("y")))
    # a null code never matches on the other day, so its rows of yesterday count as missing
    missing = F.when((F.col("t") == 0) | F.col("code_insee").isNull(), F.col("y")).otherwise(F.lit(0))
    totals = per_code.agg(
        F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("nb_communes_aujourd_hui"),
        F.coalesce(F.sum("y"), F.lit(0)).cast("bigint").alias("nb_communes_hier"),
        F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias("nb_communes_manquantes"),
    )
    return totals.select(
        today.alias("date_check"), yesterday.alias("date_reference"),
        "nb_communes_aujourd_hui", "nb_communes_hier", "nb_communes_manquantes",
        coverage_status("nb_communes_manquantes", "nb_communes_hier").alias("statut"),
    )


def missing_zones(stg: DataFrame, today=None) -> DataFrame:
    """Yesterday's rows whose code has no row today, marked MANQUANT.

    A left anti join of yesterday's codes against today's distinct codes; both
    sides read one day (partition pruning on a stored table). Duplicated codes
    of yesterday stay duplicated and a null code is always missing, as with a
    left join and a null test.
    """
    today, yesterday = _look_back(stg, today)
    day = F.col("date_ech")
    y = stg.filter(day == yesterday).select("code_insee")
    t = stg.filter(day == today).select("code_insee").distinct()
    return y.join(t, "code_insee", "left_anti").select("code_insee", F.lit(K.MISSING).alias("statut"))


def missing_departments(dep: DataFrame, today=None) -> DataFrame:
    """``mon_departement_manquant``: départements present yesterday and absent today.

    One row per missing département with the global count and status, or a
    single OK row when none is missing.
    """
    today, yesterday = _look_back(dep, today)
    day = F.col("date_ech")
    per_dept = (dep.filter((day == today) | (day == yesterday))
                .groupBy("code_departement")
                .agg(F.max(day == today).alias("t"), F.max(day == yesterday).alias("y")))
    missing = per_dept.filter(F.col("y") & (~F.col("t") | F.col("code_departement").isNull()))
    n_missing = missing.select(F.count(F.lit(1))).scalar()
    rows = missing.select(
        today.alias("date_check"), yesterday.alias("date_reference"), "code_departement",
        F.lit(K.MISSING).alias("statut"),
        n_missing.cast("bigint").alias("nb_departements_manquants"),
        departments_status(n_missing).alias("statut_global"))
    summary = (per_dept.agg(F.count(F.lit(1)))   # one row, also without any département
               .select(today.alias("date_check"), yesterday.alias("date_reference"),
                       F.lit(None).cast("string").alias("code_departement"),
                       F.lit(K.STATUS_OK).alias("statut"),
                       F.lit(0).cast("bigint").alias("nb_departements_manquants"),
                       F.lit(K.STATUS_OK).alias("statut_global"))
               .filter(n_missing == 0))
    return rows.unionByName(summary)


def global_status(coverage: DataFrame, departments: DataFrame) -> DataFrame:
    """Worst of the coverage status and the département status, in one row."""
    dept_status = departments.select(F.max("statut_global")).scalar()
    n_dept = departments.select(F.max("nb_departements_manquants")).scalar()
    return coverage.select(
        "date_check",
        F.col("statut").alias("statut_couverture"),
        dept_status.alias("statut_departements"),
        worst_status(F.col("statut"), dept_status).alias("statut_global"),
        F.col("nb_communes_aujourd_hui"), F.col("nb_communes_hier"), F.col("nb_communes_manquantes"),
        F.coalesce(n_dept, F.lit(0)).cast("bigint").alias("nb_departements_manquants"),
    )


def missing_department_table(departments: DataFrame) -> DataFrame:
    """Rows of actually missing départements, without the summary row (for display)."""
    return (departments.filter(F.col("code_departement").isNotNull())
            .select(F.date_format("date_check", "yyyy-MM-dd").alias("date_check"),
                    "code_departement", "statut", "statut_global"))


class MonitoringAlert(RuntimeError):
    """Raised by :func:`gate` when a monitor is CRITICAL."""


def gate_alerts(coverage: DataFrame, departments: DataFrame) -> DataFrame:
    """One row for each CRITICAL monitor: its name, status, what is missing, and of how many (null: not known)."""
    def of(monitor: DataFrame, name: str, status: str, missing: str, of_rows: F.Column) -> DataFrame:
        return (monitor.groupBy(F.lit(name).alias("moniteur"), F.col(status).alias("statut"))
                .agg(F.max(missing).cast("bigint").alias("nb_manquants"), F.max(of_rows).cast("bigint").alias("nb_reference"))
                .where(F.col("statut") == K.STATUS_CRITICAL))

    return of(coverage, "zone coverage", "statut", "nb_communes_manquantes", F.col("nb_communes_hier")).unionByName(
        of(departments, "missing départements", "statut_global", "nb_departements_manquants", F.lit(None)))


def gate(coverage: DataFrame, departments: DataFrame) -> list:
    """Stop the run if a monitor alerts; without alerts an empty list. WARN passes."""
    alerts = gate_alerts(coverage, departments).collect()   # at most one row per monitor
    if alerts:
        raise MonitoringAlert("; ".join(f"{a.moniteur} {a.statut}: {a.nb_manquants} missing" for a in alerts))
    return alerts
