"""Declared schemas and the fixed vocabularies of the flight data model.

The raw table is declared once instead of being inferred: inference costs an
extra pass over the source and makes column types depend on the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw flight table: 35 columns, in file order. Fixed values, as all name
# lists of this module.
# ---------------------------------------------------------------------------
RAW_FIELDS: list[tuple[str, T.DataType]] = [
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day_of_month", T.IntegerType()),
    ("day_of_week", T.IntegerType()),
    ("fl_date", T.DateType()),
    ("op_unique_carrier", T.StringType()),
    ("op_carrier_fl_num", T.DoubleType()),
    ("origin", T.StringType()),
    ("origin_city_name", T.StringType()),
    ("origin_state_nm", T.StringType()),
    ("dest", T.StringType()),
    ("dest_city_name", T.StringType()),
    ("dest_state_nm", T.StringType()),
    ("crs_dep_time", T.IntegerType()),
    ("dep_time", T.DoubleType()),
    ("dep_delay", T.DoubleType()),
    ("taxi_out", T.DoubleType()),
    ("wheels_off", T.DoubleType()),
    ("wheels_on", T.DoubleType()),
    ("taxi_in", T.DoubleType()),
    ("crs_arr_time", T.IntegerType()),
    ("arr_time", T.DoubleType()),
    ("arr_delay", T.DoubleType()),
    ("cancelled", T.DoubleType()),
    ("cancellation_code", T.StringType()),
    ("diverted", T.DoubleType()),
    ("crs_elapsed_time", T.DoubleType()),
    ("actual_elapsed_time", T.DoubleType()),
    ("air_time", T.DoubleType()),
    ("distance", T.DoubleType()),
    ("carrier_delay", T.IntegerType()),
    ("weather_delay", T.IntegerType()),
    ("nas_delay", T.IntegerType()),
    ("security_delay", T.IntegerType()),
    ("late_aircraft_delay", T.IntegerType()),
]

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]

# Types after cleaning (C2): flags become int, the two delays double.
CLEAN_OVERRIDES: dict[str, T.DataType] = {
    "month": T.IntegerType(),
    "cancelled": T.IntegerType(),
    "diverted": T.IntegerType(),
    "arr_delay": T.DoubleType(),
    "dep_delay": T.DoubleType(),
}
CLEAN_SCHEMA = T.StructType(
    [T.StructField(n, CLEAN_OVERRIDES.get(n, t), True) for n, t in RAW_FIELDS]
)

# What names a flight of the raw table.
FLIGHT_KEYS = ["fl_date", "op_unique_carrier", "origin", "dest", "crs_dep_time"]

# Codes normalised by cleaning.
CODE_COLUMNS = ["op_unique_carrier", "origin", "dest"]

# HHMM clock columns read by the time checks.
CLOCK_COLUMNS = ["crs_dep_time", "dep_time", "wheels_off", "wheels_on", "crs_arr_time", "arr_time"]

# Columns read by each analysis (what the pruned scans ask the Parquet reader for).
ROUTE_COLUMNS = ["op_unique_carrier", "origin", "dest", "month", "arr_delay", "cancelled"]
BAND_COLUMNS = [
    "origin", "month", "dep_delay", "arr_delay", "cancelled", "cancellation_code",
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
]
RANKING_COLUMNS = ["origin", "op_unique_carrier", "dep_delay", "arr_delay", "cancelled"]

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's output contract.
# ---------------------------------------------------------------------------

# Delay bands of a flown, late flight, in report order, then the cancelled band.
BAND_LOW = "low"
BAND_MEDIUM = "medium"
BAND_HIGH = "high"
BAND_CANCELLED = "cancelled"
BAND_ORDER = [BAND_LOW, BAND_MEDIUM, BAND_HIGH, BAND_CANCELLED]
LOW_BELOW = 15      # dep_delay < 15 -> low
MEDIUM_UP_TO = 60   # dep_delay <= 60 -> medium, above -> high

# Cause columns of a delayed flight; the cause name is the column name.
DELAY_CAUSE_COLUMNS = [
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
]

# Cancellation code -> cause of a cancelled flight; any other code has no cause.
CANCEL_CAUSES = {"A": "carrier", "B": "weather", "C": "nas", "D": "security"}

# Month number -> English name; other numbers keep their number as text.
MONTH_NAMES = {
    1: "January", 2: "February", 3: "March", 4: "April", 5: "May", 6: "June",
    7: "July", 8: "August", 9: "September", 10: "October", 11: "November", 12: "December",
}

# Text read as missing in a raw CSV cell (the pandas default NA tokens).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Dataset sizes written by the scaling step, as fractions of the cleaned table.
DATASET_SIZES = [0.25, 0.5, 0.75, 1, 2, 4]
SAMPLE_SEED = 42

# Names of the seven time-consistency checks, in report order.
TIME_CHECKS = [
    "dep_delay", "arr_delay", "taxi_out", "taxi_in", "air_time", "actual_elapsed_time",
    "components_sum",
]
# Fields whose error examples are shown.
EXAMPLE_FIELDS = ["taxi_out", "taxi_in", "air_time", "actual_elapsed_time"]
