from pyspark.sql import functions as F

from airlens.functions import constants as K
from airlens.functions.expr import (argmax_names, bands_ascending, bands_descending, coverage_status,
                                    departments_status, pct, round_half, worst_status)


def test_round_half_matches_binary_rounding(spark):
    import duckdb
    values = [0.285, 1.005, 2.675, 201 / 200, -0.125] + [k / n for n in range(1, 60) for k in range(0, 6 * n + 1)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half("x", 2)).collect()]
    con = duckdb.connect()
    want = [r[0] for r in con.execute("SELECT round(x, 2) FROM (SELECT unnest(?::double[]) AS x)", [values]).fetchall()]
    assert got == want
    assert got[:2] == [0.28, 1.0]


def test_pct_is_double_and_rounded(spark):
    df = spark.createDataFrame([(1,), (1,), (3,)], "q int")
    out = df.agg(pct(F.col("q") <= 2).alias("p"))
    assert out.schema["p"].dataType.simpleString() == "double"
    assert out.collect()[0]["p"] == 66.7


def test_argmax_names_ties_nulls_empty(spark):
    df = spark.createDataFrame([(3, 3, 1, 2, 3), (None, 1, None, None, None), (None, None, None, None, None)],
                               "a int, b int, c int, d int, e int")
    got = [r[0] for r in df.select(argmax_names(["a", "b", "c", "d", "e"])).collect()]
    assert got == [["NO2", "O3", "SO2"], ["O3"], []]


def test_bands_null_goes_to_else(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (45.0,), (None,)], "w double")
    got = [r[0] for r in df.select(bands_ascending("w", K.WIND_BANDS, K.WIND_BAND_ELSE)).collect()]
    assert got == [K.WIND_BANDS[0][0], K.WIND_BANDS[1][0], K.WIND_BAND_ELSE, K.WIND_BAND_ELSE]
    df2 = spark.createDataFrame([(3.0,), (2.5,), (2.49,), (None,)], "i double")
    got2 = [r[0] for r in df2.select(bands_descending("i", K.INDEX_BANDS, K.INDEX_BAND_ELSE)).collect()]
    assert got2 == [K.INDEX_BANDS[0][0], K.INDEX_BANDS[1][0], K.INDEX_BAND_ELSE, K.INDEX_BAND_ELSE]


def test_statuses(spark):
    df = spark.createDataFrame([(0, 10), (2, 10), (20, 100), (21, 100)], "m long, y long")
    got = [r[0] for r in df.select(coverage_status("m", "y")).collect()]
    assert got == ["OK", "WARN", "WARN", "CRITICAL"]   # exactly 20 percent is still WARN
    d = spark.createDataFrame([(0,), (10,), (11,)], "m long")
    assert [r[0] for r in d.select(departments_status("m")).collect()] == ["OK", "WARN", "CRITICAL"]
    s = spark.createDataFrame([("OK", "WARN"), ("CRITICAL", "OK"), ("OK", None)], "a string, b string")
    assert [r[0] for r in s.select(worst_status("a", "b")).collect()] == ["WARN", "CRITICAL", "OK"]


def test_dominant_by_prefix_and_suffix(spark):
    from airlens.functions.expr import dominant, pollutant_columns
    assert pollutant_columns("pct", "declencheur")[0] == "pct_no2_declencheur"
    assert pollutant_columns("code") == ["code_no2", "code_o3", "code_pm10", "code_pm25", "code_so2"]
    df = spark.createDataFrame([(10.0, 50.0, 50.0, 0.0, 0.0)], ", ".join(f"{c} double" for c in pollutant_columns("pct", "declencheur")))
    assert df.select(dominant("pct", "declencheur")).collect()[0][0] == ["O3", "PM10"]
