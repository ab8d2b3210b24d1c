"""Hot keys: one city and the null weather value each hold a third of the fact.
Broadcast and shuffle plans must give the same rows."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from crashlake.operators import dense_index, keep_smallest
from crashlake.plans import marts, quality, transforms


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def _no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30_000
    ids = spark.range(n)
    raw = ids.select(
        F.concat(F.lit("A-"), F.col("id").cast("string")).alias("ID"),
        F.when(F.col("id") % 7 == 0, F.lit("bad")).otherwise(F.lit("2016-05-03 06:07:08")).alias("Start_Time"),
        F.when(F.col("id") < n // 3, F.lit("Hot")).otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("City"),
        F.lit("OH").alias("State"),
        F.concat(F.lit("K"), (F.col("id") % 20).cast("string")).alias("Airport_Code"),
        *[F.lit(None).cast("string").alias(c) for c in ("End_Time", "Timezone")],
        F.lit("x").alias("Description"),
        (F.col("id") % 5).cast("string").alias("Severity"),
        *[F.lit(None).cast("string").alias(c) for c in ("Temperature(F)", "Distance(mi)", "Wind_Speed(mph)", "Precipitation(in)")],
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("W"), (F.col("id") % 4).cast("string"))).alias("Weather_Condition"),
        F.lit(None).cast("string").alias("Weather_Timestamp"),
    )
    cities_raw = spark.createDataFrame(
        [("Hot", "Ohio", "OH", "1")] * 3 + [(f"C{i}", "Ohio", "OH", str(i)) for i in range(0, 50, 2)],
        "City string, State string, `State Code` string, `Total Population` string",
    )
    cities = transforms.build_cities(cities_raw)
    weather = transforms.build_weather_conditions(raw)
    return raw, cities, weather


def _rows(df):
    return sorted(tuple(r) for r in df.select("accident_id", "city_id", "weather_condition_id").collect())


def test_broadcast_and_shuffle_plans_agree(spark, skewed):
    raw, cities, weather = skewed
    rb = _rows(transforms.build_accidents(raw, cities, weather))
    with _no_broadcast(spark):
        s = transforms.build_accidents(raw, cities, weather)
        assert "SortMergeJoin" in _plan(s) and "BroadcastHashJoin" not in _plan(s)
        rs = _rows(s)
    assert rb == rs
    assert len(rb) == 10_000 + 10_000  # the hot city and the even-numbered C-cities
    assert sum(1 for r in rb if r[2] is None) == sum(1 for r in rb if int(r[0][2:]) % 3 == 0)


def test_orphans_agree_across_plans(spark, skewed):
    raw, cities, weather = skewed
    fact = transforms.build_accidents(raw, cities, weather)
    refs = [("city", "city_id", cities, "city_id"), ("weather", "weather_condition_id", weather, "weather_condition_id")]
    a = sorted(tuple(r) for r in quality.fk_orphans(fact, refs).collect())
    with _no_broadcast(spark):
        b = sorted(tuple(r) for r in quality.fk_orphans(fact, refs).collect())
    assert a == b == [("city", 0), ("weather", 0)]


def test_hot_key_aggregates(spark, skewed):
    raw, cities, weather = skewed
    fact = transforms.build_accidents(raw, cities, weather)
    by_city = {r["city_name"]: r["n"] for r in marts.by_city(fact, cities).collect()}
    assert by_city["Hot"] == 10_000
    # dedupe of a hot key keeps exactly one row, chosen deterministically
    typed = transforms.typed_cities(raw.select("City", "State", F.col("State").alias("State Code"), F.col("Severity").alias("Total Population")))
    kept = keep_smallest(typed, ["city_name", "state_name"], ["total_population"])
    assert kept.filter(F.col("city_name") == "Hot").collect()[0]["total_population"] == 0


def test_dense_index_with_a_hot_prefix(spark):
    # many rows share the first key column; the second column makes the order total
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, F.lit("hot")).otherwise(F.lit("cold")).alias("a"), F.col("id"))
    got = dense_index(df, ["a", "id"], "i", num_partitions=6)
    assert got.agg(F.min("i"), F.max("i"), F.countDistinct("i")).head() == (0, 19_999, 20_000)
    assert got.filter((F.col("a") == "cold") & (F.col("id") == 15_000)).head()["i"] == 0
