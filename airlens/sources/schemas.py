"""Declared schemas of the raw inputs, reference tables and published tables."""

from pyspark.sql import types as T

S, I, D, F32, B, SH, L, DT = (T.StringType(), T.IntegerType(), T.DoubleType(), T.FloatType(),
                             T.ByteType(), T.ShortType(), T.LongType(), T.DateType())


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# columns of the raw daily air quality file that the engine uses (the file has 22)
RAW_AIR = struct(
    ("date_ech", S), ("code_zone", S), ("lib_zone", S), ("type_zone", S), ("source", S),
    ("code_qual", I), ("lib_qual", S), ("coul_qual", S),
    ("code_no2", I), ("code_o3", I), ("code_pm10", I), ("code_pm25", I), ("code_so2", I),
    ("x_wgs84", D), ("y_wgs84", D),
)

RAW_WEATHER = struct(
    ("date_ech", S), ("code_departement", S), ("latitude", D), ("longitude", D),
    ("temperature_mean", D), ("temperature_max", D), ("temperature_min", D),
    ("rain_sum", D), ("wind_speed_max", D), ("precipitation_sum", D), ("weathercode", D),
)

# per-location response of the weather service: a start instant (epoch seconds,
# UTC) and parallel arrays with one value per day
WEATHER_MEASURES = ("temperature_mean", "temperature_max", "temperature_min", "rain_sum",
                    "wind_speed_max", "precipitation_sum", "weathercode")
WEATHER_PAYLOAD = T.StructType(
    [T.StructField("location_id", I, True), T.StructField("start_time", L, True)]
    + [T.StructField(m, T.ArrayType(D, True), True) for m in WEATHER_MEASURES]
)

COMMUNES = struct(("COM", S), ("DEP", S), ("TYPECOM", S))
EPCI = struct(("SIREN", S), ("code_departement", S), ("code_region", S))
CENTROIDS = struct(("location_id", I), ("code_departement", S), ("lon", D), ("lat", D))

STG_AIR = struct(
    ("date_ech", DT), ("code_insee", S), ("nom_commune", S), ("type_zone", S), ("source_aasqa", S),
    ("code_qual", B), ("lib_qual", S), ("coul_qual", S),
    ("code_no2", B), ("code_o3", B), ("code_pm10", B), ("code_pm25", B), ("code_so2", B),
    ("polluants_declencheurs", T.ArrayType(S, False)), ("code_departement", S),
    ("longitude", F32), ("latitude", F32),
)

STG_WEATHER = struct(
    ("date_ech", DT), ("code_departement", S), ("latitude", F32), ("longitude", F32),
    ("temperature_mean", F32), ("temperature_max", F32), ("temperature_min", F32),
    ("rain_sum", F32), ("precipitation_sum", F32), ("wind_speed_max", F32), ("weathercode", SH),
)
