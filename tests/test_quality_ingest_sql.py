import pytest
from pyspark.sql import functions as F

from airlens.operators import quality
from airlens.plans import sqlapi
from airlens.sources import ingest
from airlens.sources.schemas import RAW_AIR
from tests import frames as fx


def test_rule_inventory():
    assert len(quality.RULES) == 41
    kinds = [r.test for r in quality.RULES]
    assert kinds.count("not_null") == 32 and kinds.count("accepted_values") == 8 and kinds.count("unique") == 1
    assert sum(r.severity == "warn" for r in quality.RULES) == 2


def test_quality_report_counts_failures(spark):
    nat = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-01", None), (None, 2.0)],
                                "date_ech string, indice_moyen_national double")
    cov = spark.createDataFrame([("2024-01-01", 3, "BAD"), ("2024-01-01", 3, "OK")],
                                "date_check string, nb_communes_aujourd_hui long, statut string")
    rep = {(r.model, r.column_name, r.test): (r.failures, r.status)
           for r in quality.quality_report({"mart_atmo_daily_national": nat, "mon_commune_coverage": cov}).collect()}
    assert rep[("mart_atmo_daily_national", "date_ech", "unique")] == (1, "fail")
    assert rep[("mart_atmo_daily_national", "date_ech", "not_null")] == (1, "fail")
    assert rep[("mart_atmo_daily_national", "indice_moyen_national", "not_null")] == (1, "fail")
    assert rep[("mon_commune_coverage", "statut", "accepted_values")] == (1, "fail")
    assert rep[("mon_commune_coverage", "statut", "not_null")] == (0, "pass")


def test_warn_severity(spark):
    md = spark.createDataFrame([("2024-01-01", "01", 1.0, None, None)],
                               "date_ech string, code_departement string, indice_moyen double, "
                               "temperature_max float, wind_speed_max float")
    rep = quality.quality_report({"mart_atmo_meteo_daily_departement": md})
    assert {r.status for r in rep.filter(F.col("column_name") == "temperature_max").collect()} == {"warn"}
    assert quality.failed(rep).count() == 0


def _write_csv(spark, path, rows, extra_cols=7):
    df = fx.raw_air(spark, rows)
    for i in range(extra_cols):
        df = df.withColumn(f"extra_{i}", F.lit("x"))
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def test_header_check_and_pinned_code(spark, tmp_store):
    good, bad = tmp_store + "/good", tmp_store + "/bad"
    _write_csv(spark, good, [fx.raw_row(code="01001")])
    _write_csv(spark, bad, [fx.raw_row()], extra_cols=6)
    df = ingest.read_raw_csv(spark, good)
    assert df.collect()[0].code_zone == "01001" and df.schema["code_qual"].dataType.simpleString() == "int"
    with pytest.raises(ingest.SchemaError, match="expected 22 columns, got 21"):
        ingest.read_raw_csv(spark, bad)


def test_ingest_day_skip_rerun_and_empty_day(spark, tmp_store):
    csv, root = tmp_store + "/csv", tmp_store + "/store"
    _write_csv(spark, csv, [fx.raw_row(date="2024-03-04"), fx.raw_row(date="2024-03-05", code="x")])
    assert ingest.ingest_day(spark, csv, root, "2024-03-04") == {"day": "2024-03-04", "status": "saved", "rows": 1}
    assert ingest.ingest_day(spark, csv, root, "2024-03-04")["status"] == "skipped"
    with pytest.raises(ingest.EmptyDayError):
        ingest.ingest_day(spark, csv, root, "2024-03-09")
    assert ingest.read_store(spark, root).count() == 1


def test_backfill_saves_new_days_and_skips_stored(spark, tmp_store):
    root = tmp_store + "/store"
    first = fx.raw_air(spark, [fx.raw_row(date="2024-03-01"), fx.raw_row(date="2024-03-02")])
    assert ingest.ingest_days(spark, first, root)["saved"] == 2
    again = fx.raw_air(spark, [fx.raw_row(date="2024-03-02", code="new"), fx.raw_row(date="2024-03-03")])
    rep = ingest.ingest_days(spark, again, root)
    assert (rep["saved"], rep["skipped"]) == (1, 1)
    got = sorted((r.date_ech, r.code_zone) for r in ingest.read_store(spark, root).collect())
    assert got == [("2024-03-01", "01001"), ("2024-03-02", "01001"), ("2024-03-03", "01001")]


def test_read_only_sql(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string").createOrReplaceTempView("mart_atmo_commune")
    assert sqlapi.read_only_sql(spark, "SELECT * FROM mart_atmo_commune ORDER BY n DESC;").collect()[0].n == 2
    assert sqlapi.read_only_sql(spark, "WITH t AS (SELECT n FROM mart_atmo_commune) SELECT n FROM t -- note").count() == 2
    for bad in ["DROP VIEW mart_atmo_commune", "CREATE TABLE x AS SELECT 1", "SET a = 1",
                "SELECT 1; SELECT 2", "INSERT INTO mart_atmo_commune VALUES (3, 'c')"]:
        res = sqlapi.run_console(spark, bad)
        assert not res["ok"] and res["error"]
    ok = sqlapi.run_console(spark, "select s from mart_atmo_commune")
    assert ok["ok"] and ok["n_rows"] == 2 and ok["n_columns"] == 1


def test_console_returns_and_counts_every_row(spark):
    spark.range(25_000).selectExpr("id AS n").createOrReplaceTempView("mart_atmo_commune")
    res = sqlapi.run_console(spark, "SELECT n FROM mart_atmo_commune")
    assert res["ok"] and res["n_rows"] == 25_000 and res["data"].count() == 25_000


def test_console_reads_published_tables_only(spark):
    spark.range(3).selectExpr("id AS n").createOrReplaceTempView("mart_atmo_commune")
    spark.range(3).createOrReplaceTempView("private_view")
    for bad in ["SELECT reflect('java.lang.System', 'getProperty', 'user.name')", "SELECT * FROM text.`/etc/passwd`",
                "SELECT java_method('java.util.UUID', 'randomUUID')", "SELECT * FROM private_view",
                "SELECT n FROM mart_atmo_commune WHERE n IN (SELECT id FROM private_view)",
                "WITH t AS (SELECT * FROM private_view) SELECT * FROM t", "SELECT * FROM range(3)"]:
        res = sqlapi.run_console(spark, bad)
        assert not res["ok"] and "NotAllowed" in res["error"], bad
    assert sqlapi.run_console(spark, "WITH t AS (SELECT n FROM mart_atmo_commune) SELECT max(n) FROM t")["ok"]


def test_console_names_are_checked_where_they_lead(spark, tmp_store):
    """Names built at run time, hidden by a WITH elsewhere, or of another kind of view."""
    spark.range(3).selectExpr("id AS n").createOrReplaceTempView("mart_atmo_commune")
    spark.range(7).createOrReplaceTempView("private_view")
    spark.range(5).createOrReplaceGlobalTempView("mart_atmo_commune")
    spark.range(3).write.parquet(tmp_store)
    spark.udf.register("mine", lambda x: x, "long")
    for bad in [f"SELECT * FROM IDENTIFIER('par' || 'quet.`{tmp_store}`')", f"SELECT * FROM parquet.`{tmp_store}`",
                f"SELECT * FROM IDENTIFIER/**/('parquet.`{tmp_store}`')",
                "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.name')",
                "SELECT * FROM private_view WHERE id IN (WITH private_view AS (SELECT 1 AS id) SELECT id FROM private_view)",
                "SELECT (SELECT max(id) FROM private_view)", "SELECT * FROM global_temp.mart_atmo_commune",
                "SELECT 1 WHERE EXISTS (SELECT 1 FROM private_view)", "SELECT mine(n) FROM mart_atmo_commune",
                "WITH a AS (WITH private_view AS (SELECT 1 AS id) SELECT * FROM private_view) SELECT * FROM a, private_view",
                "SELECT system.builtin.reflect('java.lang.System', 'getProperty', 'user.name')"]:
        res = sqlapi.run_console(spark, bad)
        assert not res["ok"] and ("NotAllowed" in res["error"] or "private_view" not in bad and "[" in res["error"]), bad
    for good in ["WITH private_view AS (SELECT 1 AS id) SELECT * FROM private_view", "SELECT 1", "VALUES (1), (2)",
                 "SELECT n FROM mart_atmo_commune WHERE n = (SELECT max(n) FROM mart_atmo_commune)",
                 "SELECT a.n, b.n FROM mart_atmo_commune a JOIN mart_atmo_commune b USING (n)"]:
        assert sqlapi.run_console(spark, good)["ok"], good


def test_console_runs_a_query_once_and_keeps_its_order(spark):
    touched = spark.sparkContext.accumulator(0)

    def touch(frames):
        for f in frames:
            touched.add(len(f))
            yield f

    spark.range(5_000).selectExpr("id AS n").mapInPandas(touch, "n long").createOrReplaceTempView("mart_atmo_commune")
    res = sqlapi.run_console(spark, "SELECT n FROM mart_atmo_commune WHERE n >= 0")
    assert res["n_rows"] == 5_000 and res["data"].count() == 5_000 and touched.value == 5_000
    res = sqlapi.run_console(spark, "SELECT n, n, NULL AS x FROM mart_atmo_commune ORDER BY n DESC")
    assert res["ok"] and res["n_rows"] == 5_000 and res["columns"] == ["n", "n", "x"]
    assert [r[0] for r in sqlapi.page(res["data"], 2, 100).collect()] == list(range(4799, 4699, -1))
    assert [r[0] for r in res["data"].toLocalIterator()] == list(range(4999, -1, -1))


def test_csv_headers_of_all_files_are_checked(spark, tmp_store):
    import os
    os.makedirs(tmp_store)
    with open(tmp_store + "/a.csv", "w") as f:
        f.write('code_no2,code_o3,nom\n1,2,"L ""Est"", nord"\n')
    assert ingest.read_csv_text(spark, tmp_store).collect()[0].nom == 'L "Est", nord'
    with open(tmp_store + "/b.csv", "w") as f:
        f.write("code_o3,code_no2,nom\n2,1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.read_csv_text(spark, tmp_store).collect()


def test_rows_without_a_day_are_rejected_and_counted(spark, tmp_store):
    rows = fx.raw_air(spark, [fx.raw_row(date=d) for d in ("2024-03-01", None, "soon", "2024-13-45")])
    rep = ingest.ingest_days(spark, rows, tmp_store)
    assert (rep["saved"], rep["skipped"], rep["rejected"]) == (1, 0, 3)
    assert ingest.read_store(spark, tmp_store).count() == 1


def test_export_csv(spark, tmp_store):
    df = spark.createDataFrame([("01", ["NO2", "O3"])], "code string, p array<string>")
    sqlapi.export_result(df, tmp_store + "/out")
    back = spark.read.option("header", True).csv(tmp_store + "/out").collect()
    assert back[0].p == "NO2|O3"


def test_raw_schema_is_not_mutated():
    assert len(RAW_AIR.fields) == 15


def test_accepted_values_counts_distinct_offending_values(spark):
    stg = spark.createDataFrame([(9, 1), (9, 1), (0, 1), (None, 1), (3, 7)], "code_qual int, code_no2 int")
    rules = [r for r in quality.RULES if r.model == "stg_atmo_daily" and r.column in ("code_qual", "code_no2")]
    rep = {(r.column_name, r.test): r.failures for r in quality.check_table(stg, rules).collect()}
    assert rep[("code_qual", "accepted_values")] == 2      # 9 and 0; null is not checked
    assert rep[("code_no2", "accepted_values")] == 1
    assert rep[("code_qual", "not_null")] == 1
