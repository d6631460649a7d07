import datetime as dt

from airlens.operators import analysis as A
from airlens.operators import marts
from airlens.operators.staging import air_staging
from airlens.plans.models import Models
from tests import frames as fx
from tests.conftest import SF_SMALL


def _stg(spark, rows):
    return air_staging(fx.raw_air(spark, rows), fx.communes(spark), fx.epci(spark))


def test_zones_lost_between_two_days_and_all_days(spark):
    rows = [fx.raw_row(date="2024-03-03", code="a"), fx.raw_row(date="2024-03-03", code="b"),
            fx.raw_row(date="2024-03-04", code="a"), fx.raw_row(date="2024-03-06", code="a")]
    stg = _stg(spark, rows)
    assert [r.code_insee for r in A.zones_lost(stg, "2024-03-03", "2024-03-04").collect()] == ["b"]
    got = sorted((r.code_insee, r.date_ech) for r in A.zones_lost(stg).collect())
    # 03-05 has no row at all, so all of 03-04 is lost; the newest day has nothing to be compared with
    assert got == [("a", dt.date(2024, 3, 4)), ("b", dt.date(2024, 3, 3))]


def test_zone_history_search_and_rankings(spark):
    rows = [fx.raw_row(date=f"2024-03-0{d}", code=c, name=n, qual=q, no2=q)
            for d in range(1, 4) for c, n, q in [("01001", "Saint-Ex", 1), ("01002", "Autre", 3), ("99", None, 2)]]
    stg = _stg(spark, rows)
    hist = A.zone_history(stg, "01001").collect()
    assert [r.date_ech.day for r in hist] == [3, 2, 1]
    prof = marts.zone_profile(stg)
    assert [r.code_insee for r in A.search_zones(prof, "saint").collect()] == ["01001"]
    assert [r.code_insee for r in A.search_zones(prof, "0100").collect()] == ["01001", "01002"]
    assert [r.code_insee for r in A.ranked_named_zones(prof, n=1, worst=True).collect()] == ["01002"]
    assert [r.code_insee for r in A.best_zones(prof, min_days=3, n=2).collect()] == ["01001", "99"]


def test_headline_and_dominant_of_day(spark):
    rows = [fx.raw_row(code="a", qual=1, no2=1, o3=1), fx.raw_row(code="b", qual=4, pm10=4)]
    stg = _stg(spark, rows)
    h = A.headline(marts.daily_national(stg)).collect()[0]
    assert (h.nb_communes, h.nb_bon, h.pct_bon) == (2, 1, 50.0)
    dom = A.dominant_of_day(marts.daily_department(stg)).collect()
    assert len(dom) == 1


def _plan(df, mode="formatted"):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_staging_plan_prelimits_before_shuffle_and_broadcasts_lookup(spark):
    m = Models.from_tables(spark, SF_SMALL)
    plan = _plan(m.stg_atmo_daily, "simple")
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning(code_insee")
    assert exchange < partial          # the partial limit sits below (before) the shuffle
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_marts_aggregate_partially_and_filters_reach_the_scan(spark):
    m = Models.from_tables(spark, SF_SMALL)
    plan = _plan(m.mart_atmo_daily_national, "simple")
    assert "partial_avg" in plan and "partial_count" in plan
    scan = _plan(m.raw_air.filter("code_zone is not null"), "formatted")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in scan


def test_stored_staging_prunes_days_for_monitors(spark):
    m = Models.from_tables(spark, SF_SMALL, stored=True)
    cov = m.mon_commune_coverage
    assert cov.count() == 1
    scans = [b for b in _plan(cov).split("\n\n") if "Scan parquet" in b and "stg_atmo_daily" in b]
    # the rows of two days only: partition filters on the day, one data column read; the newest day needs no scan of it
    assert scans and all("date_ech" in b.split("PartitionFilters:")[1].split("\n")[0]
                         and "ReadSchema: struct<code_insee:string>" in b for b in scans)


def test_newest_day_comes_from_partition_names(spark, tmp_store):
    from airlens.plans import rebuild
    from airlens.sources.store import partition_days
    stg = _stg(spark, [fx.raw_row(date=f"2024-03-0{d}") for d in (1, 2, 3)])
    rebuild._save(stg, tmp_store, "stg_atmo_daily")
    assert partition_days(spark, tmp_store + "/stg_atmo_daily") == ["2024-03-01", "2024-03-02", "2024-03-03"]
    assert partition_days(spark, tmp_store + "/absent") == []


def test_zone_profile_needs_one_shuffle(spark):
    stg = spark.createDataFrame([], _stg(spark, [fx.raw_row()]).schema)
    assert _plan(marts.zone_profile(stg), "simple").count("Exchange") == 1


def test_queries_see_replaced_files(spark, tmp_store):
    """Nothing of an earlier call is reused: a folder's new files give the new answer."""
    import os
    import shutil
    from airlens.plans.registry import QUERIES
    folder = tmp_store.removeprefix("file:")
    shutil.copytree(SF_SMALL, folder)
    os.chmod(folder, 0o755)
    total = lambda: QUERIES["daily_national"](spark, folder).agg({"nb_communes": "sum"}).first()[0]
    before = total()
    half = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_id % 2 = 0")
    os.remove(f"{folder}/events.parquet")
    half.write.parquet(f"{folder}/events.parquet")
    assert total() < before


def test_join_is_the_same_with_and_without_broadcast(spark):
    raw = fx.raw_air(spark, [fx.raw_row(code=c) for c in ("01001", "02001", "zz")])
    plain = air_staging(raw, fx.communes(spark), fx.epci(spark), broadcast_max_bytes=0)
    assert "BroadcastHashJoin" not in _plan(plain, "simple").split("Initial Plan")[0]
    assert sorted(map(str, plain.collect())) == sorted(map(str, air_staging(raw, fx.communes(spark), fx.epci(spark)).collect()))


def test_sentinel_filters_reach_the_store_scan(spark, tmp_store):
    from airlens.sources import ingest
    ingest.ingest_days(spark, fx.raw_air(spark, [fx.raw_row(), fx.raw_row(qual=7)]), tmp_store)
    stg = air_staging(ingest.read_store(spark, tmp_store), fx.communes(spark), fx.epci(spark))
    plan = _plan(stg)
    scan = [b for b in plan.split("\n\n") if "Scan parquet" in b and tmp_store in b][0]
    pushed = scan.split("PushedFilters:")[1].split("\n")[0]
    assert "IsNotNull(code_zone)" in pushed and "Not(In(code_qual, [0,7]))" in pushed
    assert stg.count() == 1


def test_hot_zone_holding_a_third_of_rows(spark):
    hot = [fx.raw_row(code="01001", qual=1 + i % 6, no2=1 + i % 6, source=f"S{i}") for i in range(300)]
    rest = [fx.raw_row(code=f"9{i:04d}", qual=2) for i in range(600)]
    stg = _stg(spark, hot + rest)
    rows = {r.code_insee: r for r in stg.collect()}
    assert len(rows) == 601 and rows["01001"].code_qual == 6
    dep = {r.code_departement: r.nb_communes for r in marts.daily_department(stg).collect()}
    assert dep["01"] == 1 and sum(dep.values()) == 601


def test_search_case_rules(spark):
    rows = [fx.raw_row(date=f"2024-03-0{d}", code=c, name=n) for d in (1, 2)
            for c, n in [("2A004", "Ajaccio"), ("2B033", "Bastia"), ("01001", None)]]
    prof = marts.zone_profile(_stg(spark, rows))
    assert [r.code_insee for r in A.search_zones(prof, "AJAC").collect()] == ["2A004"]   # name: any case
    assert [r.code_insee for r in A.search_zones(prof, "2A").collect()] == ["2A004"]     # code: exact case
    assert A.search_zones(prof, "2a").count() == 0
