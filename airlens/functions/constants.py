"""Fixed values of the domain.

These values must stay exactly as written for results to match the source
pipeline: pollutant names and their order, sentinel index values, labels,
thresholds, status names and band labels.
"""

# --- fixed values -----------------------------------------------------------
# pollutants, in the order used everywhere (arrays of dominant pollutants keep it)
POLLUTANTS = ("NO2", "O3", "PM10", "PM25", "SO2")

# index columns of a reading and their pollutant names
SUB_INDEX_COLUMNS = ("code_no2", "code_o3", "code_pm10", "code_pm25", "code_so2")
INDEX_COLUMNS = ("code_qual",) + SUB_INDEX_COLUMNS

# index values meaning "no usable index"; rows holding one are dropped
SENTINEL_INDICES = (0, 7)

# valid index scale and its labels
INDEX_LEVELS = (1, 2, 3, 4, 5, 6)
INDEX_LABELS = {
    1: "Bon",
    2: "Moyen",
    3: "Dégradé",
    4: "Mauvais",
    5: "Très mauvais",
    6: "Extrêmement mauvais",
}
INDEX_COLOURS = {
    1: "#2DD4BF",
    2: "#86EFAC",
    3: "#FDE68A",
    4: "#F87171",
    5: "#B91C1C",
    6: "#6B21A8",
}

# "acceptable" air is index <= 2, "bad or worse" is index >= 4
ACCEPTABLE_MAX = 2
BAD_MIN = 4

# zone codes whose département is given by hand (after both reference tables)
ZONE_OVERRIDES = {"200096675": "56"}

# delegated communes are dropped from the commune reference table
DELEGATED_COMMUNE_TYPE = "COMD"

# WGS84 ranges a coordinate pair must fall in
LONGITUDE_RANGE = (-180, 180)
LATITUDE_RANGE = (-90, 90)

# monitoring statuses, mildest first
STATUS_OK = "OK"
STATUS_WARN = "WARN"
STATUS_CRITICAL = "CRITICAL"
STATUSES = (STATUS_OK, STATUS_WARN, STATUS_CRITICAL)
MISSING = "MANQUANT"

# zone coverage: CRITICAL when more than 20 percent (1/5) of yesterday's rows are missing
COVERAGE_CRITICAL_FRACTION = (1, 5)
# départements: WARN up to 10 missing, CRITICAL above
DEPARTMENTS_WARN_MAX = 10

# bands of the weather analyses: (label, lower bound inclusive) high to low for the index,
# (label, upper bound exclusive) low to high for wind and temperature
INDEX_BANDS = (
    ("🔴 Dégradé ou pire (>=3)", 3),
    ("🟡 Entre 2.5 et 3", 2.5),
)
INDEX_BAND_ELSE = "🟢 Bon (< 2.5)"
WIND_BANDS = (
    ("🌬️ Vent faible (<10)", 10),
    ("💨 Vent modéré (10-20)", 20),
    ("🌪️ Vent fort (20-40)", 40),
)
WIND_BAND_ELSE = "🌪️ Très fort (>40)"
TEMPERATURE_BANDS = (
    ("❄️ Froid (<10°)", 10),
    ("🌤️ Tempéré (10-20°)", 20),
    ("☀️ Chaud (20-30°)", 30),
)
TEMPERATURE_BAND_ELSE = "🔥 Très chaud (>30°)"

# raw daily air quality file: number of columns the header must have
RAW_AIR_COLUMN_COUNT = 22
# --- end of fixed values ----------------------------------------------------
