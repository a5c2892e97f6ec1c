"""Column maps and schemas for raw, staged and cleaned tables.

Raw files are always read with a declared schema (never inferred); the
maps below drive both the read and the staging projection (P1-P6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference: raw header names (including
# the double space in "Trip  Duration" and the degree signs), the staged
# names and types they map to, and the parse applied on the way.
# Each entry: (raw header, staged name, staged type, parse or None).
# ---------------------------------------------------------------------------
TRIP_COLUMNS = [
    ("Trip Id", "trip_id", "bigint", None),
    ("Trip  Duration", "trip_duration", "bigint", None),
    ("Start Station Id", "start_station_id", "bigint", None),
    ("Start Time", "start_time", "timestamp_ntz", "trip_time"),
    ("Start Station Name", "start_station_name", "string", None),
    ("End Station Id", "end_station_id", "string", None),
    ("End Time", "end_time", "timestamp_ntz", "trip_time"),
    ("End Station Name", "end_station_name", "string", None),
    ("Bike Id", "bike_id", "bigint", None),
    ("User Type", "user_type", "string", None),
]

WEATHER_PRIMARY_COLUMNS = [
    ("Longitude (x)", "longitude", "double", None),
    ("Latitude (y)", "latitude", "double", None),
    ("Station Name", "station_name", "string", None),
    ("Climate ID", "climate_id", "bigint", None),
    ("Date/Time", "date_time", "date", None),
    ("Year", "year", "bigint", None),
    ("Month", "month", "string", None),
    ("Day", "day", "string", None),
    ("Data Quality", "data_quality", "string", None),
    ("Max Temp (°C)", "max_temp_c", "double", None),
    ("Max Temp Flag", "max_temp_flag", "string", None),
    ("Min Temp (°C)", "min_temp_c", "double", None),
    ("Min Temp Flag", "min_temp_flag", "string", None),
    ("Mean Temp (°C)", "mean_temp_c", "double", None),
]

WEATHER_SECONDARY_COLUMNS = WEATHER_PRIMARY_COLUMNS + [
    ("Mean Temp Flag", "mean_temp_flag", "string", None),
    ("Heat Deg Days (°C)", "heat_deg_days_c", "double", None),
    ("Heat Deg Days Flag", "heat_deg_days_flag", "string", None),
    ("Cool Deg Days (°C)", "cool_deg_days_c", "double", None),
    ("Cool Deg Days Flag", "cool_deg_days_flag", "string", None),
    ("Total Rain (mm)", "total_rain_mm", "string", None),
    ("Total Rain Flag", "total_rain_flag", "string", None),
    ("Total Snow (cm)", "total_snow_cm", "string", None),
    ("Total Snow Flag", "total_snow_flag", "string", None),
    ("Total Precip (mm)", "total_precip_mm", "double", None),
    ("Total Precip Flag", "total_precip_flag", "string", None),
    ("Snow on Grnd (cm)", "snow_on_grnd_cm", "bigint", None),
    ("Snow on Grnd Flag", "snow_on_grnd_flag", "string", None),
    ("Dir of Max Gust (10s deg)", "dir_of_max_gust_10s_deg", "string", None),
    ("Dir of Max Gust Flag", "dir_of_max_gust_flag", "string", None),
    ("Spd of Max Gust (km/h)", "spd_of_max_gust_kmh", "string", None),
    ("Spd of Max Gust Flag", "spd_of_max_gust_flag", "string", None),
]

# Station records: field name, staged type.
STATION_FIELDS = [
    ("station_id", "string"),
    ("name", "string"),
    ("physical_configuration", "string"),
    ("lat", "double"),
    ("lon", "double"),
    ("altitude", "double"),
    ("address", "string"),
    ("capacity", "bigint"),
    ("is_charging_station", "boolean"),
    ("rental_methods", "array<string>"),
    ("groups", "array<string>"),
    ("obcn", "string"),
    ("short_name", "string"),
    ("nearby_distance", "double"),
    ("_ride_code_support", "boolean"),
    ("rental_uris", "map<string,string>"),
    ("post_code", "string"),
    ("is_valet_station", "boolean"),
    ("cross_street", "string"),
]

# Seeds: the restriction calendar declares every column as text except the
# 0/1 flag; the holiday list is two text columns.
RESTRICTION_SEED_DDL = (
    "dates string, hospitalizations string, icu_admissions string, "
    "inhospital_deaths string, ed_visits string, restrictions bigint"
)
HOLIDAY_SEED_DDL = "event string, date string"
# ---------------------------------------------------------------------------

CLEAN_STATION_COLUMNS = [
    "station_id", "name", "lat", "lon", "capacity", "is_charging_station", "groups",
    "obcn", "short_name", "nearby_distance", "physical_configuration", "address",
    "rental_methods",
]

CLEAN_WEATHER_COLUMNS = [
    "longitude", "latitude", "station_name", "climate_id", "date_time", "year", "month",
    "day", "max_temp_c", "min_temp_c", "mean_temp_c", "total_precip_mm", "snow_on_grnd_cm",
]


def ddl(columns) -> str:
    """Spark DDL for a staged table from a column map."""
    return ", ".join(f"`{c[1]}` {c[2]}" for c in columns)


def station_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in STATION_FIELDS))


def assert_schema(df: DataFrame, expected: str | T.StructType, *, nullable: bool = False) -> DataFrame:
    """Q4: fail fast when ``df`` does not carry the declared columns and types."""
    if isinstance(expected, str):
        expected = T.StructType.fromDDL(expected)
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if want != got:
        raise AssertionError(f"schema mismatch:\n expected {want}\n got      {got}")
    return df
