"""Dimension and fact builds (T1-T4), ``DataFrame -> DataFrame``. The only action is the
checkpoint that pins a dimension's dense keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.functions import safe_bigint, safe_date, safe_double, safe_int, safe_timestamp, state_code
from crashlake.operators import dense_index, dimension_join, distinct_values, keep_smallest

# The airport filter of the source pipeline (North America, USA).
DEFAULT_CONTINENT = "NA"
DEFAULT_COUNTRY = "US"


def build_airports(raw: DataFrame, continent: str = DEFAULT_CONTINENT, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Airports dimension (T1): filter on continent and country, derive the state from ``iso_region``.

    ``state`` and ``state_code`` are the same value; ``state`` is the partition column.
    The text ``NA`` is compared as text, never treated as null.
    """
    kept = raw.filter((F.col("continent") == F.lit(continent)) & (F.col("iso_country") == F.lit(country)))
    code = state_code("iso_region")
    return kept.select(
        F.col("ident").alias("airport_code"),
        code.alias("state_code"),
        "type",
        "name",
        "municipality",
        code.alias("state"),
    )


def typed_cities(raw: DataFrame) -> DataFrame:
    """Raw city rows with the population parsed, keyed by (City, full State)."""
    return raw.select(
        F.col("City").alias("city_name"),
        F.col("State").alias("state_name"),
        F.col("`State Code`").alias("state_code"),
        safe_bigint("Total Population").alias("total_population"),
    )


CITY_KEY = ["city_name", "state_name"]


def distinct_cities(raw: DataFrame) -> DataFrame:
    """One row per (City, State), the smallest by (State Code, population)."""
    return keep_smallest(typed_cities(raw), CITY_KEY, ["state_code", "total_population"])


def build_cities(raw: DataFrame) -> DataFrame:
    """Cities dimension (T2) of its own: ``city_id`` = dense position of (City, State) ascending."""
    return city_table(dense_index(distinct_cities(raw), CITY_KEY, "city_id"))


def city_table(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "city_id",
        "city_name",
        F.col("state_code").alias("state"),
        "state_code",
        "total_population",
    )


def build_weather_conditions(raw_accidents: DataFrame) -> DataFrame:
    """Weather dimension (T3): distinct conditions (null is one row), dense id with nulls first."""
    return weather_from_typed(raw_accidents.select(F.col("Weather_Condition").alias("_weather")))


def weather_from_typed(typed: DataFrame) -> DataFrame:
    """Weather dimension from typed accident rows (their ``_weather`` column)."""
    conditions = distinct_values(typed.select(F.col("_weather").alias("condition")), ["condition"])
    return dense_index(conditions, ["condition"], "weather_condition_id").select("weather_condition_id", "condition")


def typed_columns() -> list[Column]:
    """Columns of a raw accident row with documented types (P6); unparseable values become null."""
    return [
        F.col("ID").alias("accident_id"),
        safe_date("Start_Time").alias("datetime"),
        safe_timestamp("Start_Time").alias("start_time"),
        safe_date("Weather_Timestamp").alias("weather_date"),
        safe_int("Severity").alias("severity"),
        safe_double("Distance(mi)").alias("distance"),
        F.col("Description").alias("description"),
        safe_double("Temperature(F)").alias("temperature"),
        safe_double("Wind_Speed(mph)").alias("wind_speed"),
        safe_double("Precipitation(in)").alias("precipitation"),
        F.col("Airport_Code").alias("airport_code"),
        F.col("City").alias("_city"),
        F.col("State").alias("_state"),
        F.col("Weather_Condition").alias("_weather"),
    ]


def typed_accidents(raw: DataFrame) -> DataFrame:
    """Raw accident rows as :func:`typed_columns`."""
    return raw.select(*typed_columns())


def enrich(
    typed: DataFrame,
    cities: DataFrame,
    weather: DataFrame,
    airports: DataFrame | None = None,
) -> DataFrame:
    """Star enrichment (J1-J4): inner join to cities on (city, state code), left joins to
    airports (optional) and weather. Null keys never match, so null weather gives a null id."""
    c = cities.select(
        F.col("city_id"), F.col("city_name").alias("_c_name"), F.col("state_code").alias("_c_state")
    )
    out = dimension_join(typed, c, (F.col("_city") == F.col("_c_name")) & (F.col("_state") == F.col("_c_state")))
    if airports is not None:
        a = airports.select(F.col("airport_code").alias("_a_code"), F.col("type").alias("airport_type"))
        out = dimension_join(out, a, F.col("airport_code") == F.col("_a_code"), "left")
    w = weather.select("weather_condition_id", F.col("condition").alias("_w_cond"))
    out = dimension_join(out, w, F.col("_weather") == F.col("_w_cond"), "left")
    return out.drop("_c_name", "_c_state", "_a_code", "_w_cond")


def build_accidents(raw: DataFrame, cities: DataFrame, weather: DataFrame) -> DataFrame:
    """Accident fact (T4): typed raw rows enriched with city and weather ids, partitioned by year/month.

    Facts whose (city, state) is not in the cities dimension are dropped (inner join).
    The airport code is kept as written; the airport join adds no column.
    """
    return fact_from_typed(typed_accidents(raw), cities, weather)


def fact_from_typed(typed: DataFrame, cities: DataFrame, weather: DataFrame) -> DataFrame:
    """``build_accidents`` from rows already typed by ``typed_accidents``."""
    joined = enrich(typed, cities, weather)
    return joined.select(
        "accident_id",
        "datetime",
        "start_time",
        "weather_date",
        "severity",
        "distance",
        "description",
        "temperature",
        "wind_speed",
        "precipitation",
        "airport_code",
        "city_id",
        "weather_condition_id",
        F.year("datetime").alias("year"),
        F.month("datetime").alias("month"),
    )
