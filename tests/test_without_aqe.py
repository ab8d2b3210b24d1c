"""Results must not depend on adaptive execution or on the shuffle-partition count."""

from pyspark.sql import functions as F

from crashlake.plans import jobs, marts
from crashlake.sinks import land_chunked_csv
from crashlake.sources import read_csv, read_table


def test_build_and_land_without_aqe(spark, golden_raw, tmp_path):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        lake = str(tmp_path / "lake")
        build = jobs.build_lake(spark, golden_raw, lake)
        assert build.rows["accidents"] == 5 and build.rows["cities"] == 4 and build.rows["weather_conditions"] == 4
        cities = {r["city_name"] + "/" + r["state"]: r["city_id"] for r in read_table(spark, lake, "cities").collect()}
        assert cities == {"Dayton/OH": 0, "Los Angeles/CA": 1, "Springfield/IL": 2, "Springfield/OH": 3}
        by_state = [tuple(r) for r in marts.accidents_by_state(read_table(spark, lake, "accidents"), read_table(spark, lake, "cities")).collect()]
        assert by_state == [("OH", 3), ("CA", 1), ("IL", 1)]
        df = spark.range(0, 777).select((F.col("id") * 31 % 777).alias("k"))
        assert land_chunked_csv(df, str(tmp_path / "c"), 50, ["k"]) == {"rows": 777, "chunks": 16}
        back = read_csv(spark, str(tmp_path / "c"), recursive=False)
        assert sorted((int(r["k"]) // 50, r["chunk"]) for r in back.collect()) == [(k // 50, k // 50) for k in range(777)]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
