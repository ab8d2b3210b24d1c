"""Raw (all-string) and curated (typed) schemas of the lake."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column names consumed from the source datasets, as they
# appear in the CSV headers.
ACCIDENT_RAW_COLUMNS = [
    "ID", "Start_Time", "City", "State", "Airport_Code", "End_Time", "Timezone", "Description", "Severity",
    "Temperature(F)", "Distance(mi)", "Wind_Speed(mph)", "Precipitation(in)", "Weather_Condition",
    "Weather_Timestamp",
]
AIRPORT_RAW_COLUMNS = ["ident", "type", "name", "continent", "iso_country", "iso_region", "municipality"]
CITY_RAW_COLUMNS = ["City", "State", "State Code", "Total Population"]

# Default chunk sizes (records per raw file) and the raw folder
# of each dataset.
DEFAULT_CHUNK_RECORDS = {"accidents": 40_000, "airports": 10_000, "cities": 1_000}
RAW_FOLDERS = {"accidents": "accident_data", "airports": "airport_data", "cities": "city_data"}
RAW_DELIMITERS = {"accidents": ",", "airports": ",", "cities": ";"}


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


ACCIDENT_RAW = all_strings(ACCIDENT_RAW_COLUMNS)
AIRPORT_RAW = all_strings(AIRPORT_RAW_COLUMNS)
CITY_RAW = all_strings(CITY_RAW_COLUMNS)

CITIES = T.StructType([
    T.StructField("city_id", T.LongType(), False),
    T.StructField("city_name", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("total_population", T.LongType()),
])

AIRPORTS = T.StructType([
    T.StructField("airport_code", T.StringType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("municipality", T.StringType()),
    T.StructField("state", T.StringType()),  # partition column, last on read
])

WEATHER_CONDITIONS = T.StructType([
    T.StructField("weather_condition_id", T.LongType(), False),
    T.StructField("condition", T.StringType()),
])

ACCIDENTS = T.StructType([
    T.StructField("accident_id", T.StringType()),
    T.StructField("datetime", T.DateType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("weather_date", T.DateType()),
    T.StructField("severity", T.IntegerType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("description", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("airport_code", T.StringType()),
    T.StructField("city_id", T.LongType()),
    T.StructField("weather_condition_id", T.LongType()),
    T.StructField("year", T.IntegerType()),  # partition columns, last on read
    T.StructField("month", T.IntegerType()),
])

# table name -> (schema, partition columns)
LAKE_TABLES = {
    "cities": (CITIES, []),
    "airports": (AIRPORTS, ["state"]),
    "weather_conditions": (WEATHER_CONDITIONS, []),
    "accidents": (ACCIDENTS, ["year", "month"]),
}
