"""Declared column rules (not null, accepted values, unique) and a one-pass runner.

Failure counts follow the usual meaning of each test: null rows for
``not_null``, distinct offending values for ``accepted_values``, duplicated
values for ``unique``. A rule with ``severity="warn"`` reports ``warn``
instead of ``fail``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.functions import constants as K


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    test: str                      # not_null | accepted_values | unique
    values: tuple = field(default=())
    severity: str = "error"        # error | warn


def _not_null(model, *cols, severity="error"):
    return [Rule(model, c, "not_null", severity=severity) for c in cols]


def _accepted(model, cols, values):
    return [Rule(model, c, "accepted_values", tuple(values)) for c in cols]


# fixed values: the rules declared on the published tables (41)
RULES: list[Rule] = (
    _not_null("stg_atmo_daily", "date_ech", "code_insee", "code_departement", *K.INDEX_COLUMNS)
    + _accepted("stg_atmo_daily", K.INDEX_COLUMNS, K.INDEX_LEVELS)
    + _not_null("stg_meteo_daily", "date_ech", "code_departement", "temperature_mean", "temperature_max",
                "temperature_min", "wind_speed_max", "weathercode")
    + _not_null("mart_atmo_commune", "code_insee", "indice_moyen")
    + _not_null("mart_atmo_daily_national", "date_ech")
    + [Rule("mart_atmo_daily_national", "date_ech", "unique")]
    + _not_null("mart_atmo_daily_national", "indice_moyen_national")
    + _not_null("mart_atmo_daily_departement", "date_ech", "code_departement")
    + _not_null("mart_atmo_meteo_daily_departement", "date_ech", "code_departement", "indice_moyen")
    + _not_null("mart_atmo_meteo_daily_departement", "temperature_max", "wind_speed_max", severity="warn")
    + _not_null("mon_commune_coverage", "date_check", "nb_communes_aujourd_hui", "statut")
    + _accepted("mon_commune_coverage", ["statut"], K.STATUSES)
    + _not_null("mon_departement_manquant", "date_check", "statut_global")
    + _accepted("mon_departement_manquant", ["statut_global"], K.STATUSES)
)

REPORT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("test", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()), T.StructField("status", T.StringType()),
])


BROKEN = "model string, column_name string, test string, value string, n long"


def broken_values(df: DataFrame, rules: Sequence[Rule], *keys: str) -> DataFrame:
    """What the rules of one table find, in one scan: (model, column_name, test, value, n), counted per ``keys``.

    A row emits a (rule, value) pair for each null of a not-null column, for each value outside
    its list, and for each value of a unique column; normally few rows emit any (unique
    columns belong to small tables). Counts of different days add up, so a day's findings can be kept.
    """
    def pair(r: Rule) -> F.Column:
        c = F.col(r.column)
        found = {"not_null": c.isNull(), "accepted_values": ~c.isin(*r.values), "unique": c.isNotNull()}[r.test]
        return F.when(found, F.struct(F.lit(r.model).alias("model"), F.lit(r.column).alias("column_name"),
                                      F.lit(r.test).alias("test"), c.cast("string").alias("value")))

    emitted = F.filter(F.array(*[pair(r) for r in rules]), lambda x: x.isNotNull())
    return (df.select(*keys, F.explode(emitted).alias("b")).select(*keys, "b.*")
            .groupBy(*keys, "model", "column_name", "test", "value").agg(F.count(F.lit(1)).alias("n")))


def report_of(broken: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report of ``rules``, those that nothing breaks included, from what was found (any number of parts)."""
    names = ["model", "column_name", "test"]
    counted = (broken.groupBy(*names, "value").agg(F.sum("n").alias("n"))
               .groupBy(*names).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"),
                                    F.count_if(F.col("n") > 1).alias("repeated")))
    listed = broken.sparkSession.createDataFrame(
        [(r.model, r.column, r.test, r.severity) for r in rules],
        "model string, column_name string, test string, severity string")
    failures = (F.when(F.col("test") == "not_null", F.col("rows")).when(F.col("test") == "unique", F.col("repeated"))
                .otherwise(F.col("values")))
    # at most one row per rule
    return (listed.join(F.broadcast(counted), names, "left")
            .select("model", "column_name", "test", "severity",
                    F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"))
            .withColumn("status", F.when(F.col("failures") == 0, F.lit("pass"))
                        .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail"))))


def check_table(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Run the rules of one table in one scan."""
    return report_of(broken_values(df, rules), rules)


def rules_of(model: str, rules: Sequence[Rule] = RULES) -> list[Rule]:
    return [r for r in rules if r.model == model]


def quality_report(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rules over the given tables (rules of absent tables are skipped)."""
    out, mine = None, []
    for model, df in tables.items():
        own = rules_of(model, rules)
        if not own:
            continue
        part = broken_values(df, own)
        out = part if out is None else out.unionByName(part)
        mine += own
    if out is None:
        return SparkSession.getActiveSession().createDataFrame([], REPORT_SCHEMA)
    return report_of(out, mine)


def failed(report: DataFrame) -> DataFrame:
    """Rules with status ``fail`` (warn-only rules never stop a run)."""
    return report.filter(F.col("status") == "fail")
