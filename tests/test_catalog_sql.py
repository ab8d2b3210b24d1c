"""The lake as catalog tables: analysts' SQL against ``<db>.<table>`` runs on Spark SQL."""

import contextlib
import io

from crashlake.sources import register_lake_tables, register_lake_views


def test_questions_in_sql(spark, golden_lake, tmp_path):
    lake, _ = golden_lake
    names = register_lake_tables(spark, lake, "roadsafety", location=str(tmp_path / "roadsafety.db"))
    assert names["accidents"] == "roadsafety.accidents"

    first = spark.sql("FROM roadsafety.accidents a SELECT a.* ORDER BY a.accident_id LIMIT 3")
    assert [r["accident_id"] for r in first.collect()] == ["A-1", "A-2", "A-3"]
    assert {"year", "month", "city_id"} <= set(first.columns)

    # partition columns compared with text: cast, answered, and pruned
    month = spark.sql("SELECT count(accident_id) AS in_may FROM roadsafety.accidents WHERE month = '5' AND year IN ('2016')")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        month.explain()
    assert "PartitionFilters: [" in buf.getvalue() and "PartitionFilters: []" not in buf.getvalue()
    assert month.head()["in_may"] == 2

    told = spark.sql(
        "SELECT a.description AS told FROM roadsafety.cities AS c INNER JOIN roadsafety.accidents AS a USING (city_id) "
        "WHERE (c.city_name, c.state) = ('Dayton', 'OH') ORDER BY a.accident_id"
    )
    assert [r["told"] for r in told.collect()] == ["say \"hi\", now", "two\nlines"]

    ranking = spark.sql(
        "WITH placed AS (SELECT c.state FROM roadsafety.accidents a JOIN roadsafety.cities c USING (city_id)) "
        "SELECT state, count(*) AS total FROM placed GROUP BY ALL ORDER BY total DESC, state"
    )
    assert [tuple(r) for r in ranking.collect()] == [("OH", 3), ("CA", 1), ("IL", 1)]

    # registering again is idempotent and sees the same data
    register_lake_tables(spark, lake, "roadsafety", location=str(tmp_path / "roadsafety.db"))
    assert spark.table("roadsafety.accidents").count() == 5


def test_temp_views(spark, golden_lake):
    lake, _ = golden_lake
    names = register_lake_views(spark, lake, prefix="g_")
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {names['weather_conditions']}").head()["n"] == 4
