"""Analytical questions over the lake (V1-V4, A6-A9, J5, J6).

Group-by questions aggregate the fact *before* joining a dimension: the partial
(map-side) aggregate shrinks each task's rows to one per key, so a hot key
never lands whole in one task, and the join then sees at most one row per
dimension key. Every group-by mart takes the fact or the pre-aggregated ``counts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlake.operators.joins import dimension_join


def _count(alias: str = "n"):
    return F.count(F.lit(1)).alias(alias)


def preview(accidents: DataFrame, n: int = 10, columns: tuple[str, ...] | None = None) -> DataFrame:
    """First ``n`` facts by ``accident_id`` (V1, K4/O3), all columns or some: a top-k, not a sort of the table."""
    return accidents.select(*(columns or accidents.columns)).orderBy("accident_id").limit(n)


def count_in_month(accidents: DataFrame, year: int | str, month: int | str) -> DataFrame:
    """Facts in one month (V2). The predicate is on partition columns, so only that folder is read.

    Text literals ('1997') are cast to the column's type, as in SQL.
    """
    return accidents.filter((F.col("year") == year) & (F.col("month") == month)).agg(_count())


def _city(cities: DataFrame, city_name: str, state: str) -> DataFrame:
    return cities.filter((F.col("city_name") == city_name) & (F.col("state") == state))


def accidents_in_city(accidents: DataFrame, cities: DataFrame, city_name: str, state: str) -> DataFrame:
    """All facts of one city (V3): the filtered dimension, a row or so, is broadcast to the fact scan."""
    c = _city(cities, city_name, state).select("city_id", "city_name", "state")
    facts = accidents.select("city_id", "description", "accident_id")
    return dimension_join(facts, c, "city_id").select("city_name", "state", "description", "accident_id")


def city_total(accidents: DataFrame, cities: DataFrame, city_name: str, state: str) -> DataFrame:
    """Number of facts in one city (A6)."""
    keys = _city(cities, city_name, state).select("city_id")
    return dimension_join(accidents.select("city_id"), keys, "city_id", "left_semi").agg(_count())


def _total(facts: DataFrame):
    """Rows of the fact, or the sum of ``n`` of ``counts``."""
    return F.sum("n").cast("bigint").alias("n") if "n" in facts.columns else _count()


def _per_city(facts: DataFrame) -> DataFrame:
    return facts.groupBy("city_id").agg(_total(facts))


def accidents_by_state(accidents: DataFrame, cities: DataFrame) -> DataFrame:
    """Facts per state, most first, ties by state (V4, O1)."""
    return (
        _per_city(accidents)
        .join(cities.select("city_id", "state"), "city_id")
        .groupBy("state")
        .agg(F.sum("n").cast("bigint").alias("accident_count"))
        .orderBy(F.desc("accident_count"), F.asc("state"))
    )


def by_city(accidents: DataFrame, cities: DataFrame) -> DataFrame:
    """Facts per (city name, state) (A8)."""
    return (
        _per_city(accidents)
        .join(cities.select("city_id", "city_name", "state"), "city_id")
        .groupBy("city_name", "state")
        .agg(F.sum("n").cast("bigint").alias("n"))
    )


def by_weather(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Facts per weather condition (A7, J6); facts without a condition count under null."""
    per_id = accidents.groupBy("weather_condition_id").agg(_total(accidents))
    return (
        per_id.join(weather, "weather_condition_id", "left")
        .groupBy("condition")
        .agg(F.sum("n").cast("bigint").alias("n"))
    )


def by_airport(accidents: DataFrame) -> DataFrame:
    """Facts per airport code (A9)."""
    return accidents.groupBy("airport_code").agg(_total(accidents))


def by_month(accidents: DataFrame) -> DataFrame:
    """Facts per (year, month)."""
    return accidents.groupBy("year", "month").agg(_total(accidents))


def counts(accidents: DataFrame) -> DataFrame:
    """Facts per (city, airport, weather, year, month): the one pass over the fact that all marts are rolled up from."""
    return accidents.groupBy("city_id", "airport_code", "weather_condition_id", "year", "month").agg(_count())
