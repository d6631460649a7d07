"""All models of one data set, built lazily from the inputs."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from airlens.functions import constants as K
from airlens.operators import marts, monitoring, staging
from airlens.sources import fixtures
from airlens.sources.store import materialize


@dataclass
class Models:
    """Staging, marts and monitors over one set of raw inputs (nothing runs until an action)."""

    raw_air: DataFrame
    communes: DataFrame
    epci: DataFrame
    raw_weather: DataFrame
    overrides: Mapping[str, str] = field(default_factory=lambda: dict(K.ZONE_OVERRIDES))
    stored: bool = False

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, stored: bool = False) -> "Models":
        """New models over the driver's tables in ``sf_dir``; nothing is shared between calls.

        ``stored``: staging and the daily département mart are written once, for a query that reads
        them several times, and then read from there.
        """
        i = fixtures.Inputs.load(spark, sf_dir)
        return cls(i.raw_air, i.communes, i.epci, i.raw_weather, dict(fixtures.FIXTURE_ZONE_OVERRIDES), stored)

    def with_outage(self) -> "Models":
        """The same with most zones missing on the newest day."""
        return replace(self, raw_air=fixtures.with_outage(self.raw_air))

    @cached_property
    def today(self):
        """The newest day, from the raw rows."""
        return staging.newest_day(self.raw_air)

    @property
    def stg_today(self) -> DataFrame:
        """Staging of the newest day alone: the filter reaches the raw rows."""
        return self.stg_atmo_daily.filter(F.col("date_ech") == self.today)

    @cached_property
    def stg_atmo_daily(self) -> DataFrame:
        stg = staging.air_staging(self.raw_air, self.communes, self.epci, self.overrides)
        if self.stored:
            stg = materialize(stg, "stg_atmo_daily", ["date_ech"])
        return stg

    @cached_property
    def stg_meteo_daily(self) -> DataFrame:
        return staging.weather_staging(self.raw_weather)

    @cached_property
    def mart_atmo_commune(self) -> DataFrame:
        return marts.zone_profile(self.stg_atmo_daily)

    @cached_property
    def mart_atmo_daily_departement(self) -> DataFrame:
        dep = marts.daily_department(self.stg_atmo_daily)
        return materialize(dep, "mart_atmo_daily_departement", ["date_ech"]) if self.stored else dep

    @cached_property
    def mart_atmo_daily_national(self) -> DataFrame:
        return marts.daily_national(self.stg_atmo_daily)

    @cached_property
    def mart_atmo_meteo_daily_departement(self) -> DataFrame:
        return marts.daily_with_weather(self.mart_atmo_daily_departement, self.stg_meteo_daily)

    @cached_property
    def mon_commune_coverage(self) -> DataFrame:
        return monitoring.zone_coverage(self.stg_atmo_daily, self.today)

    @cached_property
    def mon_departement_manquant(self) -> DataFrame:
        return monitoring.missing_departments(self.mart_atmo_daily_departement, self.today)

    def monitors(self) -> tuple[DataFrame, DataFrame]:
        """Both monitors from one reading of the raw rows: staging of the two days they compare is written once."""
        day = F.col("date_ech")
        recent = materialize(self.stg_atmo_daily.filter((day == self.today) | (day == F.date_sub(self.today, 1))), "recent")
        return (monitoring.zone_coverage(recent, self.today),
                monitoring.missing_departments(marts.daily_department(recent), self.today))

    def tables(self) -> dict[str, DataFrame]:
        """Published tables by name, in dependency order."""
        return {name: getattr(self, name) for name in PUBLISHED}


PUBLISHED = ("stg_atmo_daily", "stg_meteo_daily", "mart_atmo_commune", "mart_atmo_daily_national",
             "mart_atmo_daily_departement", "mart_atmo_meteo_daily_departement",
             "mon_commune_coverage", "mon_departement_manquant")


def flat(df: DataFrame, sep: str = "|") -> DataFrame:
    """Arrays of names joined as text, for comparison and CSV export."""
    cols = [F.array_join(F.col(f.name), sep).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
