"""Scalar parsing functions: ANSI-safe, null-preserving, JVM-side."""

import datetime

from pyspark.sql import functions as F

from crashlake.functions import safe_bigint, safe_date, safe_double, safe_int, safe_timestamp, state_code


def test_parsing_never_raises(spark):
    rows = [("2016-05-03 06:07:08", "3", "36.9", "US-OH"), ("not a date", "x", "", "US-"), (None, None, None, None),
            ("2016-02-30", "4.5", "1e3", "CA")]
    df = spark.createDataFrame(rows, "t string, i string, d string, r string")
    out = df.select(
        safe_date("t").alias("date"), safe_timestamp("t").alias("ts"), safe_int("i").alias("i"),
        safe_bigint("i").alias("b"), safe_double("d").alias("d"), state_code("r").alias("s"),
    ).collect()
    assert out[0]["date"] == datetime.date(2016, 5, 3) and out[0]["ts"] == datetime.datetime(2016, 5, 3, 6, 7, 8)
    assert out[0]["i"] == 3 and out[0]["b"] == 3 and out[0]["d"] == 36.9 and out[0]["s"] == "OH"
    assert out[1]["date"] is None and out[1]["ts"] is None and out[1]["i"] is None and out[1]["d"] is None
    assert out[1]["s"] == ""  # three characters dropped, nothing left
    assert all(v is None for v in out[2].asDict().values())
    assert out[3]["date"] is None  # impossible date is null, not an error
    assert out[3]["i"] is None  # "4.5" is not an integer
    assert out[3]["d"] == 1000.0 and out[3]["s"] == ""


def test_year_month_of_parsed_dates(spark):
    df = spark.createDataFrame([("2016-12-31 23:59:59",), ("bad",)], "t string")
    got = df.select(F.year(safe_date("t")).alias("y"), F.month(safe_date("t")).alias("m")).collect()
    assert [tuple(r) for r in got] == [(2016, 12), (None, None)]
