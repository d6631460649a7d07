from airlens.operators.staging import air_staging, weather_staging
from tests import frames as fx


def _stage(spark, rows, communes=None, epci=None, overrides=None):
    kw = {} if overrides is None else {"overrides": overrides}
    return air_staging(fx.raw_air(spark, rows), communes or fx.communes(spark), epci or fx.epci(spark), **kw)


def test_sentinels_null_sub_index_and_null_code_are_dropped(spark):
    rows = [fx.raw_row(qual=0), fx.raw_row(qual=7), fx.raw_row(no2=7), fx.raw_row(so2=None),
            fx.raw_row(code=None), fx.raw_row(code="01002", qual=3)]
    out = _stage(spark, rows).collect()
    assert [(r.code_insee, r.code_qual) for r in out] == [("01002", 3)]


def test_department_cascade(spark):
    communes = fx.communes(spark, [("01001", "01", "COM"), ("01003", "99", "COMD")])
    epci = fx.epci(spark, [("200000001,x", "27,28", "11")])
    rows = [fx.raw_row(code="01001"), fx.raw_row(code="200000001"), fx.raw_row(code="200096675"),
            fx.raw_row(code="01003"), fx.raw_row(code="97411")]
    out = {r.code_insee: r.code_departement for r in _stage(spark, rows, communes, epci).collect()}
    assert out == {"01001": "01", "200000001": "27", "200096675": "56", "01003": "01", "97411": "97"}


def test_duplicate_dimension_codes_do_not_multiply_rows(spark):
    communes = fx.communes(spark, [("01001", "02", "COM"), ("01001", "01", "COM")])
    out = _stage(spark, [fx.raw_row()], communes).collect()
    assert len(out) == 1 and out[0].code_departement == "01"


def test_dedupe_keeps_worst_per_code_name_day(spark):
    rows = [fx.raw_row(qual=2, source="B"), fx.raw_row(qual=4, source="A", pm10=4),
            fx.raw_row(name=None, qual=1), fx.raw_row(name=None, qual=3, o3=3),
            fx.raw_row(name="Beta", qual=1), fx.raw_row(date="2024-03-05", qual=5, pm25=5)]
    out = sorted(((str(r.date_ech), r.nom_commune or "", r.code_qual, r.polluants_declencheurs)
                  for r in _stage(spark, rows).collect()))
    assert out == [("2024-03-04", "", 3, ["O3"]), ("2024-03-04", "Alpha", 4, ["PM10"]),
                   ("2024-03-04", "Beta", 1, ["O3"]),
                   ("2024-03-05", "Alpha", 5, ["PM25"])]


def test_dedupe_tie_is_deterministic(spark):
    rows = [fx.raw_row(qual=3, source="Z", o3=3), fx.raw_row(qual=3, source="A", no2=3)]
    for _ in range(2):
        out = _stage(spark, rows).collect()
        assert [(r.source_aasqa, r.polluants_declencheurs) for r in out] == [("A", ["NO2"])]


def test_coordinates_kept_only_as_valid_pair(spark):
    rows = [fx.raw_row(code="a", x=900000.0, y=45.0), fx.raw_row(code="b", x=5.5, y=95.0),
            fx.raw_row(code="c", x=-180.0, y=90.0)]
    out = {r.code_insee: (r.longitude, r.latitude) for r in _stage(spark, rows).collect()}
    assert out == {"a": (None, None), "b": (None, None), "c": (-180.0, 90.0)}


def test_fractional_indices_round_half_even(spark):
    from pyspark.sql import functions as F
    raw = fx.raw_air(spark, [fx.raw_row(qual=3)]).withColumn("code_qual", F.lit(2.5).cast("double"))
    out = air_staging(raw, fx.communes(spark), fx.epci(spark)).collect()
    assert out[0].code_qual == 2


def test_weather_staging_types_and_rounding(spark):
    out = weather_staging(fx.weather(spark, [fx.weather_row(tmax=12.34, tmin=1.25, code=2.5)]))
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types["temperature_max"] == "float" and types["weathercode"] == "smallint"
    r = out.collect()[0]
    assert abs(r.temperature_max - 12.3) < 1e-6 and r.weathercode == 2
