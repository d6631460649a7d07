import duckdb
import pytest
from pyspark.sql import functions as F

from airlens.operators.monitoring import MonitoringAlert
from airlens.plans import registry
from airlens.plans.daily import backfill_weather, daily_air_run, daily_weather_run
from airlens.sources import ingest
from airlens.sources.schemas import RAW_WEATHER, WEATHER_PAYLOAD
from airlens.sources.store import open_table
from tests import frames as fx
from tests.conftest import SF_SMALL
from tools.compare import TABLES, digest


def _csv(spark, path, rows):
    df = fx.raw_air(spark, rows)
    for i in range(7):
        df = df.withColumn(f"extra_{i}", F.lit("x"))
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def test_daily_air_run_rebuilds_and_gates(spark, tmp_store):
    zones = [f"0100{i}" for i in range(5)]
    communes = fx.communes(spark, [(z, "01", "COM") for z in zones])
    day1 = [fx.raw_row(date="2024-03-03", code=z) for z in zones] + [fx.raw_row(date="2024-03-04", code="zz")]
    _csv(spark, tmp_store + "/d1", day1)
    out = daily_air_run(spark, tmp_store + "/d1", "2024-03-03", tmp_store + "/air", communes, fx.epci(spark),
                        tmp_store + "/out")
    assert out["ingest"]["rows"] == 5 and "mart_atmo_daily_national" in out["tables"]
    # next day: 3 of 5 zones are missing -> CRITICAL, the run stops after writing
    _csv(spark, tmp_store + "/d2", [fx.raw_row(date="2024-03-04", code=z) for z in zones[:2]])
    with pytest.raises(MonitoringAlert, match="CRITICAL"):
        daily_air_run(spark, tmp_store + "/d2", "2024-03-04", tmp_store + "/air", communes, fx.epci(spark),
                      tmp_store + "/out")
    nat = open_table(spark, tmp_store + "/out/mart_atmo_daily_national").orderBy("date_ech").collect()
    assert [r.nb_communes for r in nat] == [5, 2]


def _payload(spark):
    start = 1709424000  # 2024-03-03T00:00:00Z
    rows = [(0, start, [8.0, 9.0], [12.34, 15.0], [1.0, 2.0], [0.0, 0.1], [10.0, 25.0], [0.5, 0.0], [3.0, 61.0]),
            (1, start, [7.0, 7.5], [11.0, 13.0], [0.0, 1.0], [0.0, 0.0], [5.0, 45.0], [0.0, 2.0], [0.0, 1.0])]
    return spark.createDataFrame(rows, WEATHER_PAYLOAD)


def _locations(spark):
    return spark.createDataFrame([(0, "01", 5.3, 46.1), (1, "02", 3.5, 49.5)],
                                 "location_id int, code_departement string, lon double, lat double")


def test_backfill_and_daily_weather(spark, tmp_store):
    rep = backfill_weather(spark, _payload(spark), _locations(spark), tmp_store + "/w", tmp_store + "/json")
    assert (rep["saved"], rep["skipped"]) == (2, 0)
    rep2 = backfill_weather(spark, _payload(spark), _locations(spark), tmp_store + "/w")
    assert (rep2["saved"], rep2["skipped"]) == (0, 2)
    stored = {(r.date_ech, r.code_departement): r.temperature_max
              for r in ingest.read_store(spark, tmp_store + "/w", RAW_WEATHER).collect()}
    assert stored[("2024-03-03", "01")] == 12.34 and stored[("2024-03-04", "02")] == 13.0
    assert spark.read.json(tmp_store + "/json").count() == 4
    assert daily_weather_run(spark, _payload(spark), _locations(spark), "2024-03-04", tmp_store + "/w",
                             tmp_store + "/out")["status"] == "skipped"


def test_read_centroids(spark, tmp_store):
    import os
    os.makedirs(tmp_store, exist_ok=True)
    path = tmp_store + "/centroids.csv"
    with open(path, "w") as f:
        f.write("code_departement,lon,lat\n82,1.2855,44.0609\n26,5.1306,44.6938\n2A,8.9,41.9\n")
    got = [(r.location_id, r.code_departement) for r in ingest.read_centroids(spark, path).orderBy("location_id").collect()]
    assert got == [(0, "82"), (1, "26"), (2, "2A")]      # file order, as the service answers


def test_daily_weather_run_saves_and_rebuilds_join(spark, tmp_store):
    from airlens.plans.rebuild import run_all
    communes = fx.communes(spark, [("01001", "01", "COM"), ("02001", "02", "COM")])
    air = fx.raw_air(spark, [fx.raw_row(date="2024-03-04", code="01001"),
                             fx.raw_row(date="2024-03-04", code="02001", qual=4, pm10=4)])
    run_all(spark, air, None, communes, fx.epci(spark), tmp_store + "/out", gate=False)
    res = daily_weather_run(spark, _payload(spark), _locations(spark), "2024-03-04", tmp_store + "/w",
                            tmp_store + "/out", tmp_store + "/json")
    assert res["status"] == "saved"
    joined = {r.code_departement: (r.indice_moyen, r.temperature_max, r.weathercode)
              for r in open_table(spark, tmp_store + "/out/mart_atmo_meteo_daily_departement").collect()}
    assert joined == {"01": (2.0, 15.0, 61), "02": (4.0, 13.0, 1)}
    assert ingest.stored_days(spark, tmp_store + "/w").count() == 1


def test_cli_rebuild_and_sql(spark, tmp_store):
    import json
    import subprocess
    import sys
    import os
    os.makedirs(tmp_store, exist_ok=True)
    air = tmp_store + "/air"
    ingest.ingest_days(spark, fx.raw_air(spark, [fx.raw_row(date="2024-03-04")]), air)
    with open(tmp_store + "/communes.csv", "w") as f:
        f.write("COM,DEP,TYPECOM\n01001,01,COM\n")
    with open(tmp_store + "/epci.csv", "w") as f:
        f.write("SIREN,code_departement,code_region\n200000001,27,11\n")
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    base = [sys.executable, "-m", "airlens", "--master", "local[2]"]
    subprocess.run(base + ["rebuild", "--air-store", air, "--communes", tmp_store + "/communes.csv",
                           "--epci", tmp_store + "/epci.csv", "--out", tmp_store + "/out"],
                   check=True, env=env, capture_output=True, timeout=600)
    out = subprocess.run(base + ["sql", "--out", tmp_store + "/out",
                                 "SELECT code_departement, nb_communes FROM mart_atmo_daily_departement"],
                         check=True, env=env, capture_output=True, timeout=600, text=True)
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["ok"] and res["n_rows"] == 1
    assert json.loads(out.stdout.strip().splitlines()[-2]) == ["01", "1"]


def test_stream_ingest_takes_each_file_once(spark, tmp_store):
    from pyspark.sql import types as T
    from airlens.sources.schemas import RAW_AIR
    from airlens.streaming.file_ingest import stream_ingest
    landing, store, ckpt = tmp_store + "/landing", tmp_store + "/store", tmp_store + "/ckpt"
    schema = T.StructType(RAW_AIR.fields + [T.StructField("drop", T.IntegerType())])
    fx.raw_air(spark, [fx.raw_row(date="2024-03-03"), fx.raw_row(date="2024-03-04")]) \
        .write.partitionBy("date_ech").parquet(landing + "/drop=1")
    stream_ingest(spark, landing, store, ckpt, schema)
    stream_ingest(spark, landing, store, ckpt, schema)          # nothing new: nothing added
    assert ingest.read_store(spark, store).count() == 2
    fx.raw_air(spark, [fx.raw_row(date="2024-03-04", code="x")]) \
        .write.partitionBy("date_ech").parquet(landing + "/drop=2")
    stream_ingest(spark, landing, store, ckpt, schema)
    got = sorted((r.date_ech, r.code_zone) for r in ingest.read_store(spark, store).collect())
    assert got == [("2024-03-03", "01001"), ("2024-03-04", "01001"), ("2024-03-04", "x")]
    # the batch ingest shares the store: stored days are skipped, a new one is added
    more = fx.raw_air(spark, [fx.raw_row(date="2024-03-04", code="y"), fx.raw_row(date="2024-03-05", code="z")])
    assert ingest.ingest_days(spark, more, store)["saved"] == 1
    assert sorted(r.code_zone for r in ingest.read_store(spark, store).collect()) == ["01001", "01001", "x", "z"]


def test_stream_batches_can_be_retried(spark, tmp_store):
    """A batch whose commit was lost runs again, with the same rows, over the store it already wrote."""
    from pyspark.sql import types as T
    from airlens.sources.schemas import RAW_AIR
    from airlens.streaming.file_ingest import stream_ingest
    import shutil
    landing, store, ckpt = tmp_store + "/landing", tmp_store + "/store", tmp_store + "/ckpt"
    schema = T.StructType(RAW_AIR.fields + [T.StructField("drop", T.IntegerType())])
    fx.raw_air(spark, [fx.raw_row(date="2024-03-03"), fx.raw_row(date="2024-03-04")]) \
        .write.partitionBy("date_ech").parquet(landing + "/drop=1")
    assert stream_ingest(spark, landing, store, ckpt, schema) == 1
    shutil.rmtree((ckpt + "/commits").removeprefix("file:"))
    assert stream_ingest(spark, landing, store, ckpt, schema) == 1
    assert ingest.read_store(spark, store).count() == 2


def test_run_day_replaces_and_empties_days(spark, tmp_store):
    """A corrected day loses its old rows; a day left with sentinel rows only disappears."""
    from airlens.plans.rebuild import run_all, run_day
    communes, epci = fx.communes(spark), fx.epci(spark)
    air = tmp_store + "/air"
    ingest.write_days(fx.raw_air(spark, [fx.raw_row(date=f"2024-03-0{d}", code=c) for d in (3, 4, 5)
                                         for c in ("01001", "02001")]), air)
    run_all(spark, air, None, communes, epci, tmp_store + "/inc", gate=False)
    ingest.write_days(fx.raw_air(spark, [fx.raw_row(date="2024-03-04", code="01001", qual=5),
                                         fx.raw_row(date="2024-03-05", qual=7)]), air)
    for day in ("2024-03-04", "2024-03-05"):
        inc = run_day(spark, day, air, None, communes, epci, tmp_store + "/inc", gate=False)
    full = run_all(spark, air, None, communes, epci, tmp_store + "/full", gate=False)
    for name in full:
        assert sorted(map(str, inc[name].collect())) == sorted(map(str, full[name].collect())), name
    assert inc["stg_atmo_daily"].count() == 3


def test_empty_weather_day_is_an_error(spark, tmp_store):
    with pytest.raises(ingest.EmptyDayError):
        daily_weather_run(spark, _payload(spark), _locations(spark), "1990-01-01", tmp_store + "/w", tmp_store + "/out")
    assert ingest.stored_days(spark, tmp_store + "/w").count() == 0


def test_run_day_equals_full_rebuild(spark, tmp_store):
    from airlens.plans.rebuild import run_all, run_day
    from tools.compare import digest
    communes = fx.communes(spark, [("01001", "01", "COM"), ("02001", "02", "COM"), ("03001", "03", "COM")])
    days = {"2024-03-03": [("01001", 2), ("02001", 3), ("03001", 1), ("03001", 5)],
            "2024-03-04": [("01001", 4), ("02001", 1)],
            "2024-03-05": [("01001", 1), ("03001", 6), ("04001", 2)]}
    air, weather = tmp_store + "/air", tmp_store + "/weather"
    wrows = [fx.weather_row(date=d, dept=dep, tmax=10.0 + i) for i, d in enumerate(days) for dep in ("01", "02")]
    ingest.ingest_days(spark, fx.weather(spark, wrows), weather)
    for d, rows in days.items():
        raw = [fx.raw_row(date=d, code=c, qual=q, no2=q, source=f"S{i}") for i, (c, q) in enumerate(rows)]
        ingest.ingest_days(spark, fx.raw_air(spark, raw), air)
        inc = run_day(spark, d, air, weather, communes, fx.epci(spark), tmp_store + "/inc", gate=False)
    full = run_all(spark, air, weather, communes, fx.epci(spark), tmp_store + "/full", gate=False)
    assert set(inc) == set(full)
    for name in full:
        a, b = inc[name].collect(), full[name].select(*inc[name].columns).collect()
        assert digest([tuple(r) for r in a], inc[name].columns)[0] == digest([tuple(r) for r in b], inc[name].columns)[0], name


def test_days_built_one_at_a_time_give_the_full_mart(spark):
    """rebuild_day builds every new day of the store: its rows are those of the plain daily département mart."""
    rows = registry.QUERIES["rebuild_day"](spark, SF_SMALL)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    full = con.sql(registry.ORACLE["daily_department"])
    got, expected = [tuple(r) for r in rows.collect()], full.fetchall()
    assert sorted(rows.columns) == sorted(full.columns) and len(got) == len(expected)
    assert digest(got, rows.columns)[0] == digest(expected, full.columns)[0]
