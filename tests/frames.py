"""Hand-made frames of the reference's raw shapes, a few rows each."""

from airlens.sources.schemas import RAW_AIR, RAW_WEATHER, COMMUNES, EPCI


def raw_row(date="2024-03-04", code="01001", name="Alpha", type_zone="commune", source="S1",
            qual=2, no2=1, o3=2, pm10=1, pm25=1, so2=1, x=5.0, y=45.0, lib=None, coul=None):
    return (date, code, name, type_zone, source, qual, lib, coul, no2, o3, pm10, pm25, so2, x, y)


def raw_air(spark, rows):
    return spark.createDataFrame(rows, RAW_AIR)


def communes(spark, rows=(("01001", "01", "COM"),)):
    return spark.createDataFrame(list(rows), COMMUNES)


def epci(spark, rows=(("200000001", "27,28", "11"),)):
    return spark.createDataFrame(list(rows), EPCI)


def weather(spark, rows):
    return spark.createDataFrame(rows, RAW_WEATHER)


def weather_row(date="2024-03-04", dept="01", tmax=12.34, tmin=1.25, wind=15.0, code=3.0):
    return (date, dept, 45.0, 5.0, 8.0, tmax, tmin, 0.0, wind, 0.5, code)
