import datetime as dt

import pytest

from airlens.operators import marts, monitoring
from airlens.operators.staging import air_staging, weather_staging
from tests import frames as fx


def _stg(spark, rows):
    return air_staging(fx.raw_air(spark, rows), fx.communes(spark), fx.epci(spark))


def test_zone_profile_rounds_like_binary_and_dominant_uses_rounded_means(spark):
    # 201 readings of 1 and... mean 1.005 must round to 1.0 (binary value 1.00499..)
    rows = [fx.raw_row(date=f"2024-01-{d:02d}", qual=1, no2=1, o3=1) for d in range(1, 29)]
    rows += [fx.raw_row(date="2024-01-29", qual=2, no2=2, o3=1)]
    out = marts.zone_profile(_stg(spark, rows)).collect()[0]
    assert out.nb_jours_mesures == 29 and out.nb_jours_bon == 28 and out.nb_jours_moyen == 1
    assert out.indice_moyen == round(29 / 29 + 1 / 29 - 1 / 29 * 0, 2) or out.indice_moyen == 1.03
    assert out.pct_jours_acceptable == 100.0
    assert out.polluants_dominants == ["NO2"]


def test_department_counts_distinct_codes_national_counts_rows(spark):
    rows = [fx.raw_row(code="01001", name="A"), fx.raw_row(code="01001", name="B"),
            fx.raw_row(code="01002", name="C", qual=4, pm10=4)]
    stg = _stg(spark, rows)
    dep = marts.daily_department(stg).collect()[0]
    nat = marts.daily_national(stg).collect()[0]
    assert dep.nb_communes == 2 and nat.nb_communes == 3
    assert nat.nb_mauvais_ou_pire == 1 and dep.pct_acceptable == 66.7


def test_weather_join_keeps_repeated_weather_keys(spark):
    stg = _stg(spark, [fx.raw_row()])
    w = weather_staging(fx.weather(spark, [fx.weather_row(), fx.weather_row(tmax=20.0)]))
    out = marts.daily_with_weather(marts.daily_department(stg), w).collect()
    assert len(out) == 2


def _day(d, codes, dept="01"):
    return [fx.raw_row(date=d, code=c) for c in codes]


def test_coverage_ok_warn_critical_and_exact_twenty_percent(spark):
    y = [f"0100{i}" for i in range(5)]
    ok = _stg(spark, _day("2024-03-03", y) + _day("2024-03-04", y)).transform(monitoring.zone_coverage).collect()[0]
    assert (ok.statut, ok.nb_communes_manquantes) == ("OK", 0)
    warn = _stg(spark, _day("2024-03-03", y) + _day("2024-03-04", y[:4]))
    w = monitoring.zone_coverage(warn).collect()[0]
    assert (w.statut, w.nb_communes_manquantes, w.nb_communes_hier) == ("WARN", 1, 5)   # exactly 20 %
    crit = monitoring.zone_coverage(_stg(spark, _day("2024-03-03", y) + _day("2024-03-04", y[:3]))).collect()[0]
    assert crit.statut == "CRITICAL" and crit.date_reference == dt.date(2024, 3, 3)


def test_coverage_without_previous_day_is_ok_and_empty_staging(spark):
    r = monitoring.zone_coverage(_stg(spark, _day("2024-03-01", ["a"]) + _day("2024-03-04", ["b"]))).collect()[0]
    assert (r.statut, r.nb_communes_hier, r.nb_communes_aujourd_hui) == ("OK", 0, 1)
    empty = _stg(spark, [fx.raw_row(qual=0)])
    e = monitoring.zone_coverage(empty).collect()[0]
    assert e.date_check is None and e.statut == "OK" and e.nb_communes_aujourd_hui == 0


def test_missing_departments_rows_summary_and_critical(spark):
    communes = fx.communes(spark, [(f"{i:02d}001", f"{i:02d}", "COM") for i in range(1, 13)])
    y = [fx.raw_row(date="2024-03-03", code=f"{i:02d}001") for i in range(1, 13)]
    t = [fx.raw_row(date="2024-03-04", code="01001")]
    stg = air_staging(fx.raw_air(spark, y + t), communes, fx.epci(spark))
    out = monitoring.missing_departments(marts.daily_department(stg)).collect()
    assert len(out) == 11 and {r.statut_global for r in out} == {"CRITICAL"}
    assert {r.nb_departements_manquants for r in out} == {11}
    none_missing = air_staging(fx.raw_air(spark, y), communes, fx.epci(spark))
    s = monitoring.missing_departments(marts.daily_department(none_missing)).collect()
    assert len(s) == 1 and s[0].code_departement is None and s[0].statut_global == "OK"


def test_gate_raises_on_critical_and_passes_warn(spark):
    y = [f"0100{i}" for i in range(5)]
    crit = _stg(spark, _day("2024-03-03", y) + _day("2024-03-04", y[:3]))
    dep = monitoring.missing_departments(marts.daily_department(crit))
    with pytest.raises(monitoring.MonitoringAlert, match="zone coverage CRITICAL: 2 missing"):
        monitoring.gate(monitoring.zone_coverage(crit), dep)
    warn = _stg(spark, _day("2024-03-03", y) + _day("2024-03-04", y[:4]))
    assert monitoring.gate(monitoring.zone_coverage(warn),
                           monitoring.missing_departments(marts.daily_department(warn))) == []
    g = monitoring.global_status(monitoring.zone_coverage(warn),
                                 monitoring.missing_departments(marts.daily_department(warn))).collect()[0]
    assert g.statut_global == "WARN"


def test_missing_zones_keeps_duplicates_and_null_codes(spark):
    y = spark.createDataFrame(
        [(dt.date(2024, 3, 3), "a", "A1"), (dt.date(2024, 3, 3), "a", "A2"), (dt.date(2024, 3, 3), None, "N"),
         (dt.date(2024, 3, 3), "b", "B"), (dt.date(2024, 3, 4), "b", "B"), (dt.date(2024, 3, 4), None, "N")],
        "date_ech date, code_insee string, nom_commune string")
    got = sorted((r.code_insee or "", r.statut) for r in monitoring.missing_zones(y).collect())
    assert got == [("", "MANQUANT"), ("a", "MANQUANT"), ("a", "MANQUANT")]
    cov = monitoring.zone_coverage(y).collect()[0]
    assert (cov.nb_communes_manquantes, cov.nb_communes_hier, cov.statut) == (3, 4, "CRITICAL")
