"""Tables behind a commit log: crashes, conflicts, appends, and rebuilds that read the new days only."""

import glob
import os

import pytest

from airlens.plans import rebuild
from airlens.sources import ingest, manifest
from airlens.sources.schemas import RAW_AIR
from airlens.streaming.file_ingest import stream_ingest
from tests import frames as fx
from tools.compare import digest


def _rows(spark, *days, code="01001", **more):
    return fx.raw_air(spark, [fx.raw_row(date=d, code=code, **more) for d in days])


def _codes(df):
    return sorted((r.date_ech, r.code_zone) for r in df.collect())


def test_a_writer_that_dies_before_its_commit_changes_nothing(spark, tmp_store, monkeypatch):
    ingest.write_days(_rows(spark, "2024-03-01", "2024-03-02"), tmp_store)
    with monkeypatch.context() as m:
        def die(*_):
            raise RuntimeError("killed")
        m.setattr(manifest, "publish", die)
        with pytest.raises(RuntimeError, match="killed"):
            ingest.write_days(_rows(spark, "2024-03-02", "2024-03-03", code="new"), tmp_store)
    assert _codes(ingest.read_store(spark, tmp_store)) == [("2024-03-01", "01001"), ("2024-03-02", "01001")]
    assert ingest.stored_days(spark, tmp_store).count() == 2
    assert manifest.vacuum(spark, tmp_store) == 1 and manifest.vacuum(spark, tmp_store) == 0
    ingest.write_days(_rows(spark, "2024-03-02", "2024-03-03", code="new"), tmp_store)
    assert _codes(ingest.read_store(spark, tmp_store)) == [
        ("2024-03-01", "01001"), ("2024-03-02", "new"), ("2024-03-03", "new")]


def test_of_two_writers_one_commits(spark, tmp_store):
    ingest.write_days(_rows(spark, "2024-03-01"), tmp_store)
    base = manifest.snapshot(spark, tmp_store)
    first = manifest.store(_rows(spark, "2024-03-02"), tmp_store, "c1")
    second = manifest.store(_rows(spark, "2024-03-03"), tmp_store, "c2")
    manifest.publish(spark, base, {**base.days, **first})
    with pytest.raises(manifest.CommitConflict):
        manifest.publish(spark, base, {**base.days, **second})
    assert manifest.snapshot(spark, tmp_store).day_list() == ["2024-03-01", "2024-03-02"]


def test_a_reader_keeps_its_snapshot_and_old_files_go(spark, tmp_store):
    ingest.write_days(_rows(spark, "2024-03-01", code="c0"), tmp_store)
    before = ingest.read_store(spark, tmp_store)
    for k in range(1, manifest.KEPT):
        ingest.write_days(_rows(spark, "2024-03-01", code=f"c{k}"), tmp_store)
    assert _codes(before) == [("2024-03-01", "c0")]
    ingest.write_days(_rows(spark, "2024-03-01", code="last"), tmp_store)
    assert _codes(ingest.read_store(spark, tmp_store)) == [("2024-03-01", "last")]
    left = glob.glob(tmp_store.removeprefix("file:") + "/_data/*/date_ech=*")
    assert len(left) == manifest.KEPT
    assert len(os.listdir(tmp_store.removeprefix("file:") + "/_log")) <= 2 * manifest.KEPT   # and checksums


def test_days_and_rows_come_from_the_log(spark, tmp_store):
    ingest.write_days(_rows(spark, "2024-03-02", "2024-03-01", "2024-03-02"), tmp_store)
    state = manifest.snapshot(spark, tmp_store)
    assert {d: e["rows"] for d, e in state.days.items()} == {"2024-03-01": 1, "2024-03-02": 2}
    one = ingest.read_store(spark, tmp_store, days=["2024-03-01"])
    assert all("date_ech=2024-03-01" in f for f in one.inputFiles()) and one.count() == 1
    assert ingest.read_store(spark, tmp_store, days=["1999-01-01"]).count() == 0
    assert ingest.read_store(spark, tmp_store + "/absent").count() == 0
    assert manifest.snapshot(spark, tmp_store + "/absent").day_list() == []


def test_stream_batches_are_added_beside_the_files_of_a_day(spark, tmp_store):
    landing, store, ckpt = tmp_store + "/landing", tmp_store + "/store", tmp_store + "/ckpt"
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(
        store.removeprefix("file:") + "/_data/*/*/*.parquet")}
    _rows(spark, "2024-03-01").write.parquet(landing + "/a")
    stream_ingest(spark, landing + "/*", store, ckpt, RAW_AIR)
    before = files()
    _rows(spark, "2024-03-01", code="02001").write.parquet(landing + "/b")
    stream_ingest(spark, landing + "/*", store, ckpt, RAW_AIR)
    after = files()
    assert before.items() <= after.items() and len(after) > len(before)
    assert _codes(ingest.read_store(spark, store)) == [("2024-03-01", "01001"), ("2024-03-01", "02001")]


def _same(a, b):
    assert set(a) == set(b)
    for name in a:
        x, y = a[name].collect(), b[name].select(*a[name].columns).collect()
        assert digest([tuple(r) for r in x], a[name].columns)[0] == digest([tuple(r) for r in y], a[name].columns)[0], name


def _inputs(spark):
    return fx.communes(spark, [(c, c[:2], "COM") for c in ("01001", "02001", "03001")]), fx.epci(spark)


def _days(spark, days, **more):
    rows = [fx.raw_row(date=d, code=c, qual=1 + (int(d[-2:]) + k) % 6, no2=1 + int(d[-2:]) % 5)
            for d in days for k, c in enumerate(("01001", "02001", "03001")) if (int(d[-2:]) + k) % 4]
    return fx.raw_air(spark, rows)


def test_new_days_are_built_without_old_staging(spark, tmp_store):
    """All new days in one pass; staging of the days before the last is not there any more."""
    dims = _inputs(spark)
    air, out = tmp_store + "/air", tmp_store + "/out"
    old = [f"2024-02-2{d}" for d in range(4, 10)] + ["2024-03-01", "2024-03-02"]
    new = ["2024-03-03", "2024-03-04", "2024-03-05"]
    ingest.ingest_days(spark, _days(spark, old), air)
    rebuild.run_all(spark, air, None, *dims, out, gate=False)
    for file in glob.glob(out.removeprefix("file:") + "/stg_atmo_daily/_data/*/date_ech=*/*"):
        if old[-1] not in file:
            os.remove(file)
    ingest.ingest_days(spark, _days(spark, new), air)
    assert rebuild.days_to_build(spark, air, None, out) == new
    before = {n: manifest.snapshot(spark, f"{out}/{n}").version for n in ("stg_atmo_daily", "quality_findings", "zone_month_sums")}
    got = rebuild.run_missing(spark, air, None, *dims, out, gate=False)
    assert {n: manifest.snapshot(spark, f"{out}/{n}").version - v for n, v in before.items()} == dict.fromkeys(before, 1)
    full = rebuild.run_all(spark, air, None, *dims, tmp_store + "/full", gate=False)
    for name in ("mart_atmo_commune", "mart_atmo_daily_national", "mart_atmo_daily_departement", "mon_commune_coverage",
                 "mon_departement_manquant", "quality_report"):
        _same({name: got[name]}, {name: full[name]})
    assert rebuild.days_to_build(spark, air, None, out) == []


def test_a_run_that_died_is_caught_up(spark, tmp_store, monkeypatch):
    dims = _inputs(spark)
    air, out = tmp_store + "/air", tmp_store + "/out"
    ingest.ingest_days(spark, _days(spark, ["2024-02-28", "2024-02-29"]), air)
    rebuild.run_all(spark, air, None, *dims, out, gate=False)
    ingest.ingest_days(spark, _days(spark, ["2024-03-01"]), air)
    ingest.write_days(_days(spark, ["2024-02-28"]).where("code_zone <> '02001'"), air)     # and a corrected day
    with monkeypatch.context() as m:
        def die(*_):
            raise RuntimeError("killed")
        m.setattr(rebuild, "_refresh_sums", die)
        with pytest.raises(RuntimeError, match="killed"):
            rebuild.run_missing(spark, air, None, *dims, out, gate=False)
    assert rebuild.days_to_build(spark, air, None, out) == ["2024-02-28", "2024-03-01"]
    got = rebuild.run_missing(spark, air, None, *dims, out, gate=False)
    _same(got, rebuild.run_all(spark, air, None, *dims, tmp_store + "/full", gate=False))


def test_changed_reference_tables_restage_only_days_with_changed_zones(spark, tmp_store):
    communes, epci = fx.communes(spark, [(c, c[:2], "COM") for c in ("01001", "02001", "03001", "04001")]), fx.epci(spark)
    air, out = tmp_store + "/air", tmp_store + "/out"
    rows = [("2024-02-27", "01001"), ("2024-02-27", "02001"), ("2024-02-28", "01001"), ("2024-02-29", "03001"),
            ("2024-03-01", "02001"), ("2024-03-01", "01001"), ("2024-03-02", "01001"), ("2024-03-02", "05001")]
    ingest.ingest_days(spark, fx.raw_air(spark, [fx.raw_row(date=d, code=c) for d, c in rows]), air)
    overrides = {"05001": "31"}
    rebuild.run_all(spark, air, None, communes, epci, out, overrides, gate=False)
    before = manifest.snapshot(spark, out + "/stg_atmo_daily").days
    # 02001 moves, 03001 is no longer named (its first letters say the same), 04001 moves but has no reading
    communes = fx.communes(spark, [("01001", "01", "COM"), ("02001", "2A", "COM"), ("04001", "2B", "COM")])
    got = rebuild.run_references(spark, air, None, communes, epci, out, overrides, gate=False)
    after = manifest.snapshot(spark, out + "/stg_atmo_daily").days
    assert [d for d in sorted(before) if before[d] != after[d]] == ["2024-02-27", "2024-03-01"]
    _same(got, rebuild.run_all(spark, air, None, communes, epci, tmp_store + "/full", overrides, gate=False))
    # and an override that goes
    got = rebuild.run_references(spark, air, None, communes, epci, out, {}, gate=False)
    assert [d for d, e in manifest.snapshot(spark, out + "/stg_atmo_daily").days.items() if e != after[d]] == ["2024-03-02"]
    _same(got, rebuild.run_all(spark, air, None, communes, epci, tmp_store + "/full2", {}, gate=False))
