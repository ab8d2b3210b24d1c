"""Registered queries over the driver's tables and their DuckDB oracle SQL.

Every query runs the library on data Spark derives from the given tables:
the stand-in raw datasets are landed as chunked CSV in a raw zone, the lake is
built from that raw zone and written as Parquet, and each query reads the
raw zone or the lake back. The raw zone and lake are built once per
(application, data folder) in the session's shared checkpoint folder and
reused by later queries.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlake.config import join_path, scratch_path
from crashlake.functions import safe_date, state_code
from crashlake.operators import dimension_join, distinct_values, keep_smallest
from crashlake.plans import jobs, marts, quality, transforms
from crashlake.plans.jobs import LakeBuild
from crashlake.schemas import RAW_DELIMITERS, RAW_FOLDERS
from crashlake.sinks import land_chunked_csv, write_csv, write_table
from crashlake.sinks.csv import verify_content
from crashlake.sources import file_inventory, read_csv, read_raw_dataset, read_table, register_lake_tables
from crashlake.sources import standins
from crashlake.sources.standins import DEFAULT_PARAMS, StandInParams


@dataclass
class Fixture:
    sf_dir: str
    root: str
    raw_root: str
    lake_root: str
    params: StandInParams
    landed: dict
    build: LakeBuild
    extras: dict = field(default_factory=dict)


_CACHE: dict[tuple, Fixture] = {}
_LOCK = threading.Lock()


def fixture(spark: SparkSession, sf_dir: str, params: StandInParams = DEFAULT_PARAMS) -> Fixture:
    """Land the stand-in raw zone and build the lake for ``sf_dir`` (once per application)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), params)
    with _LOCK:
        fx = _CACHE.get(key)
        if fx is None:
            root = scratch_path(spark, "fixture")
            raw_root, lake_root = join_path(root, "raw"), join_path(root, "lake")
            landed = jobs.land_raw(spark, standins.raw_sources(spark, sf_dir, params), raw_root, params.chunks())
            build = jobs.build_lake(spark, raw_root, lake_root, params.continent, params.country)
            fx = Fixture(sf_dir, root, raw_root, lake_root, params, landed, build)
            _CACHE[key] = fx
        return fx


# ---------------------------------------------------------------- accessors


def _raw(spark, fx: Fixture, dataset: str) -> DataFrame:
    """Raw dataset read with its known header (no header-inference job; every file's header is still checked)."""
    schemas = fx.extras.get("raw_schemas")
    if schemas is None:
        sources = standins.raw_sources(spark, fx.sf_dir, fx.params)
        schemas = {
            name: T.StructType([T.StructField(c, T.StringType()) for c in df.columns if not c.startswith("_")])
            for name, df in sources.items()
        }
        fx.extras["raw_schemas"] = schemas
    return read_raw_dataset(spark, fx.raw_root, dataset, schema=schemas[dataset])


def _lake(spark, fx: Fixture, table: str) -> DataFrame:
    return read_table(spark, fx.lake_root, table)


# ---------------------------------------------------------------- scans


def q_scan_csv_comma(spark, sf_dir):
    events = standins.events(spark, sf_dir)
    path = scratch_path(spark, "events_csv")
    write_csv(events, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in events.columns])
    return read_csv(spark, path, schema=schema).select("event_id", "event_type", "props")


def q_scan_csv_semicolon(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return _raw(spark, fx, "cities").select(F.col("City").alias("city"), F.col("State").alias("state"))


def q_scan_parquet_flat(spark, sf_dir):
    return read_table(spark, sf_dir, "nation.parquet").select("n_nationkey", "n_name")


def q_scan_parquet_part1(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "airports").select("airport_code", "state")


def q_scan_parquet_part2(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "accidents").select("accident_id", "year", "month")


# ---------------------------------------------------------------- sinks


def _written(spark, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    path = scratch_path(spark, "sink")
    write_table(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)


def q_sink_flat_roundtrip(spark, sf_dir):
    return _written(spark, standins.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


def q_sink_part1_roundtrip(spark, sf_dir):
    suppliers = standins.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return _written(spark, suppliers, ["s_nationkey"])


def q_sink_part2_roundtrip(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    )
    return _written(spark, orders, ["y", "m"])


def q_sql_preview(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    tables = fx.extras.get("tables")
    if tables is None:
        tables = register_lake_tables(spark, fx.lake_root, f"lake_{fx.root.rstrip('/').rsplit('/', 2)[-2]}")
        fx.extras["tables"] = tables
    return marts.preview(spark.table(tables["accidents"]), 10)


def q_sql_count_month_text(spark, sf_dir):
    """The month given as text literals, as analysts write it against the catalog."""
    q_sql_preview(spark, sf_dir)  # registers the tables
    fx = fixture(spark, sf_dir)
    table, p = fx.extras["tables"]["accidents"], fx.params
    return spark.sql(f"SELECT count(*) AS n FROM {table} WHERE year = '{p.year}' AND month = '{p.month}'")


def q_preview_5(spark, sf_dir):
    return marts.preview(_lake(spark, fixture(spark, sf_dir), "accidents"), 5, ("accident_id", "city_id", "severity"))


def q_load_report(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return quality.load_report(
        fx.build.rows["raw_accidents"],
        _lake(spark, fx, "accidents"),
        _lake(spark, fx, "cities"),
        _lake(spark, fx, "airports"),
    )


def _orders_chunks(spark, sf_dir) -> str:
    fx = fixture(spark, sf_dir)
    path = fx.extras.get("orders_chunks")
    if path is None:
        path = scratch_path(spark, "orders_chunks")
        orders = standins.table(spark, sf_dir, "orders").select("o_orderkey")
        land_chunked_csv(orders, path, 4000, ["o_orderkey"])
        fx.extras["orders_chunks"] = path
    return path


def _read_chunked(spark, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Read a chunked CSV folder keeping the ``chunk`` number from the folder names."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_csv(spark, path, sep=sep, schema=schema, recursive=False).withColumn(
        "chunk", F.col("chunk").cast("bigint")
    )


def q_chunk_assign(spark, sf_dir):
    df = _read_chunked(spark, _orders_chunks(spark, sf_dir), ["o_orderkey"])
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "chunk")


def q_chunk_sizes(spark, sf_dir):
    df = _read_chunked(spark, _orders_chunks(spark, sf_dir), ["o_orderkey"])
    return df.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))


def q_land_raw_counts(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    parts = []
    for name in ("accidents", "cities", "airports"):
        path = join_path(fx.raw_root, RAW_FOLDERS[name])
        header = read_raw_dataset(spark, fx.raw_root, name).columns
        df = _read_chunked(spark, path, header, RAW_DELIMITERS[name])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("chunk").alias("chunks")).select(
                F.lit(name).alias("dataset"), "n", "chunks"
            )
        )
    return quality.report(parts)


def q_land_source_order(spark, sf_dir):
    """Events written as several CSV files, landed as one raw dataset in file order, read back with their chunk."""
    root = scratch_path(spark, "land_source_order")
    events = standins.events(spark, sf_dir)
    write_csv(events.repartitionByRange(5, "event_id").sortWithinPartitions("event_id"), join_path(root, "src"))
    jobs.land_source(spark, "accidents", join_path(root, "src"), join_path(root, "raw"), records_per_file=700)
    df = _read_chunked(spark, join_path(root, "raw", RAW_FOLDERS["accidents"]), events.columns)
    return df.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "chunk")


#: Characters of text in a source file, about, where two files would hold more; a task writes a file.
SOURCE_FILE_CHARS = 256 << 20


def _source_files(docs: DataFrame) -> int:
    chars = docs.agg(F.sum(F.length("text").cast("long"))).head()[0] or 0
    return max(2, -(-chars // SOURCE_FILE_CHARS))


def q_land_source_multiline(spark, sf_dir):
    """Whole documents, whose texts hold line breaks, quotes and commas, landed from two files or more that many tasks read each."""
    root = scratch_path(spark, "land_source_multiline")
    docs = standins.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    write_csv(docs.repartitionByRange(_source_files(docs), "doc_id").sortWithinPartitions("doc_id"), join_path(root, "src"))
    jobs.land_source(spark, "accidents", join_path(root, "src"), join_path(root, "raw"), records_per_file=300, own_source=True)
    df = _read_chunked(spark, join_path(root, "raw", RAW_FOLDERS["accidents"]), docs.columns)
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.md5("text").alias("text_md5"), "chunk")


def q_land_content(spark, sf_dir):
    """Per raw dataset, the rows that read back with the fingerprint of the landing (a difference raises)."""
    fx = fixture(spark, sf_dir)
    rows = {name: verify_content(spark, join_path(fx.raw_root, folder)) for name, folder in RAW_FOLDERS.items()}
    return quality.report(
        [spark.range(1).select(F.lit(name).alias("dataset"), F.lit(n).cast("bigint").alias("verified_rows")) for name, n in rows.items()]
    )


def q_build_lake(spark, sf_dir):
    """A whole build beside the fixture's, then rows per table of the version that readers see."""
    fx = fixture(spark, sf_dir)
    lake = scratch_path(spark, "lake_again")
    rows = jobs.build_lake(spark, fx.raw_root, lake, fx.params.continent, fx.params.country).rows
    tables = {**jobs.lake_tables(spark, lake)}
    return quality.report(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
        + [spark.range(1).select(F.lit("dropped_no_city").alias("table_name"), F.lit(rows["dropped_no_city"]).cast("bigint").alias("n"))]
    )


def q_file_keys(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    key = F.split("key", "/")
    files = file_inventory(spark, fx.raw_root, "*.csv")
    return files.select(key[0].alias("dataset"), F.regexp_extract(key[1], "chunk=([0-9]+)", 1).cast("bigint").alias("chunk"))


def q_dq_file_count(spark, sf_dir):
    return jobs.raw_file_count(spark, fixture(spark, sf_dir).raw_root)


# ---------------------------------------------------------------- projections


def q_project_subset(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return raw.select(
        F.col("ID").alias("id"),
        F.col("Start_Time").alias("start_time"),
        F.col("City").alias("city"),
        F.col("State").alias("state"),
        F.col("Airport_Code").alias("airport_code"),
    )


def q_project_rename(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return raw.select(F.col("ID").alias("accident_id"), F.col("Weather_Condition").alias("condition"))


def q_project_duplicate(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "airports").select("airport_code", "state", "state_code")


def q_project_computed(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return raw.select(F.col("ID").alias("id"), F.concat("City", F.lit(", "), "State").alias("place"))


def q_surrogate_key_city(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "cities").select("city_id", "city_name", "state")


def q_surrogate_key_weather(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "weather_conditions").select("weather_condition_id", "condition")


def q_typed_fact(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "accidents").select(
        "accident_id", "severity", "distance", "datetime", "start_time", "weather_date", "temperature", "wind_speed", "precipitation"
    )


# ---------------------------------------------------------------- filters


def q_filter_eq(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    raw = _raw(spark, fx, "airports")
    return raw.filter(F.col("continent") == fx.params.continent).select("ident", "continent")


def q_filter_and(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    raw = _raw(spark, fx, "airports")
    return (
        raw.filter(F.col("continent") == fx.params.continent)
        .filter(F.col("iso_country") == fx.params.country)
        .select("ident")
    )


# ---------------------------------------------------------------- joins


def q_join_inner_composite(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    raw = _raw(spark, fx, "accidents").select(F.col("ID").alias("id"), F.col("City").alias("_city"), F.col("State").alias("_state"))
    c = _lake(spark, fx, "cities").select("city_id", F.col("city_name").alias("_cn"), F.col("state_code").alias("_cs"))
    j = dimension_join(raw, c, (F.col("_city") == F.col("_cn")) & (F.col("_state") == F.col("_cs")), "inner")
    return j.select("id", "city_id")


def q_join_left_using(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    raw = _raw(spark, fx, "accidents").select(F.col("ID").alias("id"), F.col("Airport_Code").alias("airport_code"))
    a = _lake(spark, fx, "airports").select("airport_code", "type")
    return dimension_join(raw, a, "airport_code", "left").select("id", "airport_code", "type")


def q_join_left_null_key(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    raw = _raw(spark, fx, "accidents").select(F.col("ID").alias("id"), F.col("Weather_Condition").alias("_w"))
    w = _lake(spark, fx, "weather_conditions")
    return dimension_join(raw, w, F.col("_w") == F.col("condition"), "left").select("id", "weather_condition_id")


def q_star_enrich(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    typed = transforms.typed_accidents(_raw(spark, fx, "accidents"))
    out = transforms.enrich(
        typed, _lake(spark, fx, "cities"), _lake(spark, fx, "weather_conditions"), _lake(spark, fx, "airports")
    )
    return out.select(F.col("accident_id").alias("id"), "city_id", "airport_type", "weather_condition_id")


# ---------------------------------------------------------------- aggregates


def q_agg_count_all(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "accidents").agg(F.count(F.lit(1)).alias("n"))


def q_dedupe_composite(spark, sf_dir):
    typed = transforms.typed_cities(_raw(spark, fixture(spark, sf_dir), "cities"))
    kept = keep_smallest(typed.select("city_name", "state_name", "total_population"), ["city_name", "state_name"], ["total_population"])
    return kept.select(F.col("city_name").alias("city"), F.col("state_name").alias("state"), "total_population")


def q_dedupe_null_group(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return distinct_values(raw.select(F.col("Weather_Condition").alias("condition")), ["condition"])


# ---------------------------------------------------------------- SQL notebook and marts


def q_sql_count_month(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return marts.count_in_month(_lake(spark, fx, "accidents"), fx.params.year, fx.params.month)


def q_sql_city_accidents(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return marts.accidents_in_city(
        _lake(spark, fx, "accidents"), _lake(spark, fx, "cities"), fx.params.city_name, fx.params.city_state
    )


def q_sql_by_state(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return marts.accidents_by_state(_lake(spark, fx, "accidents"), _lake(spark, fx, "cities"))


def q_mart_city_total(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return marts.city_total(
        _lake(spark, fx, "accidents"), _lake(spark, fx, "cities"), fx.params.city_name, fx.params.city_state
    )


def _mart(spark, sf_dir, name: str) -> DataFrame:
    """A written mart, read back; all marts are built once per fixture."""
    fx = fixture(spark, sf_dir)
    if "marts" not in fx.extras:
        root = join_path(fx.root, "marts")
        jobs.build_marts(spark, fx.lake_root, root)
        fx.extras["marts"] = root
    return spark.read.parquet(join_path(fx.extras["marts"], name))


def q_mart_by_weather(spark, sf_dir):
    return _mart(spark, sf_dir, "by_weather")


def q_mart_by_city(spark, sf_dir):
    return _mart(spark, sf_dir, "by_city")


def q_mart_by_airport(spark, sf_dir):
    return _mart(spark, sf_dir, "by_airport")


def q_mart_by_month(spark, sf_dir):
    return _mart(spark, sf_dir, "by_month")


# ---------------------------------------------------------------- scalar functions


def q_fn_to_date(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return raw.select(F.col("ID").alias("id"), safe_date("Start_Time").alias("d"))


def q_fn_year_month(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    d = safe_date("Start_Time")
    return raw.select(F.col("ID").alias("id"), F.year(d).alias("y"), F.month(d).alias("m"))


def q_fn_state_code(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "airports")
    return raw.select("ident", state_code("iso_region").alias("state_code"))


# ---------------------------------------------------------------- data quality


def q_dq_non_empty(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return quality.non_empty(
        {t: _lake(spark, fx, t) for t in ("accidents", "cities", "airports", "weather_conditions")}
    )


def q_profile_nulls(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return quality.null_profile(
        raw,
        {"start_time": safe_date("Start_Time"), "weather_condition": F.col("Weather_Condition"), "city": F.col("City")},
    )


def q_profile_duplicates(spark, sf_dir):
    typed = transforms.typed_cities(_raw(spark, fixture(spark, sf_dir), "cities"))
    cities = typed.select(F.col("city_name").alias("city"), F.col("state_name").alias("state"), "total_population")
    return quality.duplicate_profile(cities, ["city", "state"], "total_population")


def q_dq_pk_unique(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    lineitem = standins.table(spark, sf_dir, "lineitem")
    return quality.pk_unique(_lake(spark, fx, "accidents"), "accidents", ["accident_id"]).unionByName(
        quality.pk_unique(lineitem, "lineitem", ["l_orderkey", "l_linenumber"])
    )


def q_dq_fk_orphans(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return quality.fk_orphans(
        _lake(spark, fx, "accidents"),
        [
            ("airport", "airport_code", _lake(spark, fx, "airports"), "airport_code"),
            ("city", "city_id", _lake(spark, fx, "cities"), "city_id"),
            ("weather", "weather_condition_id", _lake(spark, fx, "weather_conditions"), "weather_condition_id"),
        ],
    )


def q_dq_range(spark, sf_dir):
    acc = _lake(spark, fixture(spark, sf_dir), "accidents")
    return quality.table_checks(acc, "accidents", [quality.range_check("severity", 1, 4)]).select(
        F.col("observed").alias("violations")
    )


def q_dq_format(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    acc = _lake(spark, fx, "accidents")
    check = quality.length_check("airport_code", fx.params.airport_code_length)
    return quality.table_checks(acc, "accidents", [check]).select(F.col("observed").alias("violations"))


def q_check_lake(spark, sf_dir):
    """The whole data-quality job (Q1-Q11, P6) over the lake and the raw zone."""
    fx = fixture(spark, sf_dir)
    return jobs.check_lake(spark, fx.lake_root, fx.params.airport_code_length, "^NATION_[0-9]+$", raw_root=fx.raw_root)


def q_fn_weather_date(spark, sf_dir):
    raw = _raw(spark, fixture(spark, sf_dir), "accidents")
    return raw.select(F.col("ID").alias("id"), safe_date("Weather_Timestamp").alias("d"))


def q_dq_report(spark, sf_dir):
    acc = _lake(spark, fixture(spark, sf_dir), "accidents")
    return quality.report(
        [
            quality.table_checks(
                acc, "accidents", [quality.non_empty_check(), quality.range_check("severity", 1, 4, "severity_range")]
            )
        ]
    )


# ---------------------------------------------------------------- incremental refresh


def q_stream_refresh(spark, sf_dir):
    """Build the lake from the records that arrived up to a day, then stream all
    landed loads in (some chunk files per micro-batch; what is there already changes nothing); return facts per month."""
    from crashlake.streaming import accident_refresh

    p = DEFAULT_PARAMS
    root = scratch_path(spark, "stream_refresh")
    raw_root, lake_root = join_path(root, "raw"), join_path(root, "lake")
    src = standins.raw_sources(spark, sf_dir, p)
    acc = src["accidents"]
    initial = F.col("_loaded_on") <= F.lit(p.initial_load_until).cast("date")
    jobs.land_raw(spark, {**src, "accidents": acc.filter(initial)}, raw_root, p.chunks(), load="initial")
    jobs.build_lake(spark, raw_root, lake_root, p.continent, p.country)
    jobs.land_raw(spark, {"accidents": acc.filter(~initial)}, raw_root, p.chunks(), load="later")
    accident_refresh(spark, raw_root, lake_root, join_path(root, "checkpoint"), max_files_per_trigger=4).awaitTermination()
    return read_table(spark, lake_root, "accidents").groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


def q_mart_refresh(spark, sf_dir):
    """Marts built after the initial load, then brought up to date with a later load from the months it touched."""
    p = DEFAULT_PARAMS
    root = scratch_path(spark, "mart_refresh")
    raw_root, lake_root, marts_root = (join_path(root, n) for n in ("raw", "lake", "marts"))
    src = standins.raw_sources(spark, sf_dir, p)
    acc = src["accidents"]
    initial = F.col("_loaded_on") <= F.lit(p.initial_load_until).cast("date")
    jobs.land_raw(spark, {**src, "accidents": acc.filter(initial)}, raw_root, p.chunks(), load="initial")
    jobs.build_lake(spark, raw_root, lake_root, p.continent, p.country)
    jobs.build_marts(spark, lake_root, marts_root)
    jobs.land_raw(spark, {"accidents": acc.filter(~initial)}, raw_root, p.chunks(), load="later")
    jobs.refresh_lake(spark, raw_root, lake_root, marts_root, load="later")
    mart = lambda name: spark.read.parquet(join_path(marts_root, name))
    none = F.lit(None).cast("string")
    return quality.report(
        [
            mart("by_city").select(F.lit("by_city").alias("mart"), F.col("city_name").alias("key"), F.col("state").alias("state"), "n"),
            mart("by_airport").select(F.lit("by_airport").alias("mart"), F.col("airport_code").alias("key"), none.alias("state"), "n"),
            mart("by_weather").select(F.lit("by_weather").alias("mart"), F.col("condition").alias("key"), none.alias("state"), "n"),
        ]
    )


def q_refresh_last_writer(spark, sf_dir):
    """Every record of the later load is sent three times, over tens of chunks and two loads; the last row sent must stay,
    whichever micro-batch brings it."""
    from crashlake.streaming import accident_refresh

    p = DEFAULT_PARAMS
    root = scratch_path(spark, "refresh_last_writer")
    raw_root, lake_root = join_path(root, "raw"), join_path(root, "lake")
    src = standins.raw_sources(spark, sf_dir, p)
    acc = src["accidents"]
    initial = F.col("_loaded_on") <= F.lit(p.initial_load_until).cast("date")
    later = acc.filter(~initial)
    draft = lambda what, turn: later.withColumn("Description", F.lit(what)).withColumn("_order", F.col("_order") + F.lit(turn * 10**12))
    chunks = {**p.chunks(), "accidents": 500}
    jobs.land_raw(spark, {**src, "accidents": acc.filter(initial)}, raw_root, p.chunks(), load="1")
    jobs.build_lake(spark, raw_root, lake_root, p.continent, p.country)
    jobs.land_raw(spark, {"accidents": draft("first draft", 0).unionByName(draft("second draft", 1))}, raw_root, chunks, load="9")
    jobs.land_raw(spark, {"accidents": later}, raw_root, chunks, load="10")
    accident_refresh(spark, raw_root, lake_root, join_path(root, "checkpoint"), max_files_per_trigger=16).awaitTermination()
    return read_table(spark, lake_root, "accidents").select("accident_id", "severity", "description")


def q_lasting_city_keys(spark, sf_dir):
    """Cities of one segment, which sorts first, are landed after the lake is built: no id changes, new cities are numbered
    after the old ones, and their accidents come in without the fact being built anew."""
    p = DEFAULT_PARAMS
    root = scratch_path(spark, "lasting_city_keys")
    raw_root, lake_root = join_path(root, "raw"), join_path(root, "lake")
    src = standins.raw_sources(spark, sf_dir, p)
    late = F.col("City") == F.lit("AUTOMOBILE")
    jobs.land_raw(spark, {**src, "cities": src["cities"].filter(~late)}, raw_root, p.chunks(), load="1")
    jobs.build_lake(spark, raw_root, lake_root, p.continent, p.country)
    jobs.land_raw(spark, {"cities": src["cities"].filter(late)}, raw_root, p.chunks(), load="2")
    jobs.refresh_dimensions(spark, raw_root, lake_root, continent=p.continent, country=p.country)
    cities = read_table(spark, lake_root, "cities").select("city_id", "city_name", "state")
    n = read_table(spark, lake_root, "accidents").groupBy("city_id").agg(F.count(F.lit(1)).alias("n"))
    return cities.join(n, "city_id", "left").select("city_id", "city_name", "state", F.coalesce("n", F.lit(0)).alias("n"))


# ---------------------------------------------------------------- composite builds


def q_build_airports(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "airports").select(
        "airport_code", "state", "state_code", "type", "name", "municipality"
    )


def q_build_cities(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "cities").select(
        "city_id", "city_name", "state", "state_code", "total_population"
    )


def q_build_weather(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "weather_conditions").select("weather_condition_id", "condition")


def q_build_accidents(spark, sf_dir):
    return _lake(spark, fixture(spark, sf_dir), "accidents").select(
        "accident_id", "year", "month", "datetime", "severity", "distance", "description", "airport_code",
        "city_id", "weather_condition_id",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
