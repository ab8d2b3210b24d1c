"""Raw accident, city and airport datasets derived from the driver's TPC-H-like tables.

The real inputs (an accidents CSV, a city-demographics CSV, an airport-codes
CSV) are not available, so each is stood in for by a Spark join over the
parquet tables with the same *semantics*: a fact whose composite city key may
miss the dimension, duplicated city keys with conflicting populations, null
weather conditions, unparseable start times, unknown airport codes and
airports outside the kept region. The modulo expressions below are such
data-shaping rules (which accidents spell their state so that no city
matches, which airport code a record reports, which values are unreadable); no
row of any source table is skipped. Columns carry the raw header names and are
strings, as the CSV reader would return them. Each frame also carries
``_order``, a unique source order used when it is landed in chunks, and the
accidents carry ``_loaded_on``, the day a record arrives (for incremental
loads); underscore columns are never written to the raw zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StandInParams:
    """Parameters that make the stand-ins exercise each operator."""

    # Fixed values chosen for the driver tables (see SURVEY 7.4 / 7.6).
    bad_date_every: int = 97
    unknown_weather: str = "4-NOT SPECIFIED"
    airport_codes: int = 200
    unmatched_state_nation_mod: int = 5
    bad_weather_time_every: int = 89
    bad_temperature_every: int = 101
    no_wind_every: int = 7
    continent: str = "AMERICA"
    country: str = "NATION_11"
    airport_code_length: int = 18
    city_name: str = "FURNITURE"
    city_state: str = "NATION_2"
    year: int = 1997
    month: int = 5
    initial_load_until: str = "1996-12-31"
    chunk_records: tuple[tuple[str, int], ...] = (("accidents", 4000), ("cities", 1000), ("airports", 10))

    def chunks(self) -> dict[str, int]:
        return dict(self.chunk_records)


DEFAULT_PARAMS = StandInParams()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_accidents(spark: SparkSession, sf_dir: str, p: StandInParams = DEFAULT_PARAMS) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    null = F.lit(None).cast("string")
    key, text = F.col("o_orderkey"), lambda c: c.cast("string")
    observed = F.concat(text(F.date_sub(F.col("o_orderdate").cast("date"), 1)), F.lit(" 05:06:07"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("ID"),
        F.when(F.col("o_orderkey") % p.bad_date_every == 0, F.lit("bad"))
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("Start_Time"),
        F.col("c_mktsegment").alias("City"),
        F.when(F.col("c_nationkey") % p.unmatched_state_nation_mod == 0, F.concat(F.col("n_name"), F.lit(" (old)")))
        .otherwise(F.col("n_name"))
        .alias("State"),
        F.concat(
            F.lit("Supplier#"), F.lpad((F.col("o_custkey") % p.airport_codes).cast("string"), 9, "0")
        ).alias("Airport_Code"),
        null.alias("End_Time"),
        null.alias("Timezone"),
        F.col("o_orderstatus").alias("Description"),
        F.substring("o_orderpriority", 1, 1).alias("Severity"),
        F.when(key % p.bad_temperature_every == 0, F.lit("warm"))
        .otherwise(F.concat(text(key % 120), F.lit(".5")))
        .alias("Temperature(F)"),
        F.col("o_totalprice").cast("double").cast("string").alias("Distance(mi)"),
        F.when(key % p.no_wind_every != 0, text(F.col("o_custkey") % 60)).alias("Wind_Speed(mph)"),
        F.concat(F.lit("0."), text(key % 9 + 1)).alias("Precipitation(in)"),
        F.nullif(F.col("o_orderpriority"), F.lit(p.unknown_weather)).alias("Weather_Condition"),
        F.when(key % p.bad_weather_time_every == 0, F.lit("n/a")).otherwise(observed).alias("Weather_Timestamp"),
        F.col("o_orderkey").alias("_order"),
        F.col("o_orderdate").cast("date").alias("_loaded_on"),
    )


def raw_cities(spark: SparkSession, sf_dir: str, p: StandInParams = DEFAULT_PARAMS) -> DataFrame:
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("c_mktsegment").alias("City"),
        F.col("n_name").alias("State"),
        F.col("n_name").alias("State Code"),
        F.floor("c_acctbal").cast("bigint").cast("string").alias("Total Population"),
        F.col("c_custkey").alias("_order"),
    )


def raw_airports(spark: SparkSession, sf_dir: str, p: StandInParams = DEFAULT_PARAMS) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return j.select(
        F.col("s_name").alias("ident"),
        F.when(F.col("s_acctbal") > 5000, F.lit("large")).otherwise(F.lit("small")).alias("type"),
        F.col("s_name").alias("name"),
        F.col("r_name").alias("continent"),
        F.col("n_name").alias("iso_country"),
        F.concat(F.lit("US-"), F.col("n_name")).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        F.col("s_suppkey").alias("_order"),
    )


def raw_sources(spark: SparkSession, sf_dir: str, p: StandInParams = DEFAULT_PARAMS) -> dict[str, DataFrame]:
    return {
        "accidents": raw_accidents(spark, sf_dir, p),
        "cities": raw_cities(spark, sf_dir, p),
        "airports": raw_airports(spark, sf_dir, p),
    }


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _table(spark, sf_dir, name)
