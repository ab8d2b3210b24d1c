"""Jobs: land the raw zone (T7), build the lake (T5), check the lake (T6).

Each job takes the caller's session and paths on any Hadoop file system
(``s3a://``, ``hdfs://``, ``file:``). Dimensions are written and re-read
before the fact joins them, so the ids in the fact are the ids on disk. Builds
write a new version of the lake and switch to it last (``crashlake.versions``).
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlake import changes, versions
from crashlake.config import join_path, scratch_path, shuffles_removed, staging_path
from crashlake.functions import safe_date, safe_double, safe_int
from crashlake.operators.lasting import lasting_ids
from crashlake.plans import marts, quality, transforms
from crashlake.schemas import (
    ACCIDENT_RAW_COLUMNS,
    AIRPORT_RAW_COLUMNS,
    CITY_RAW_COLUMNS,
    DEFAULT_CHUNK_RECORDS,
    LAKE_TABLES,
    RAW_DELIMITERS,
    RAW_FOLDERS,
)
from crashlake.sinks import land_chunked_csv, write_table
from crashlake.sinks.csv import CONTENT, verify_content
from crashlake.sources import file_inventory, read_csv, read_raw_dataset, read_table
from crashlake.sources.records import ORDER, read_csv_records


def land_raw(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    raw_root: str,
    chunk_records: dict[str, int] | None = None,
    order_col: str = "_order",
    load: str | None = None,
    verify: bool = True,
) -> dict[str, dict[str, int]]:
    """Land each source dataset as chunked header CSV under ``raw_root/<folder>/`` (K6, K8).

    ``sources`` maps ``accidents``/``cities``/``airports`` to a frame holding all
    source columns plus ``order_col``, a unique source order that fixes which
    records share a chunk. Columns whose name starts with ``_`` are not written.
    ``load`` lands into ``<folder>/load=<load>/`` next to earlier loads.
    The rows written must be the rows read, or it raises; with ``verify`` each
    landed folder is listed afterwards too and must hold one CSV file per chunk (T7).
    """
    sizes = {**DEFAULT_CHUNK_RECORDS, **(chunk_records or {})}
    for name, n in sizes.items():
        if n <= 0:
            raise ValueError(f"records_per_file must be > 0 (got {n} for {name})")

    def land(name: str) -> dict[str, int]:
        df = sources[name]
        dest = _raw_dest(raw_root, name, load)
        out = land_chunked_csv(
            df, dest, sizes[name], order_by=[order_col], sep=RAW_DELIMITERS[name],
            drop=[c for c in df.columns if c.startswith("_")],
        )
        if verify:
            _verify_landed(spark, dest, out)
        return out

    return concurrently(spark, {name: (lambda n=name: land(n)) for name in sources})


def _raw_dest(raw_root: str, dataset: str, load: str | None) -> str:
    return join_path(raw_root, RAW_FOLDERS[dataset], *([f"load={load}"] if load else []))


def _verify_landed(spark: SparkSession, dest: str, landed: dict[str, int]) -> None:
    """T7: the landed folder must hold exactly one CSV file per chunk, and read back the rows that were sent to it."""
    if not landed["rows"]:
        return
    check = raw_file_count(spark, dest, expected=landed["chunks"]).head()
    if not check["passed"]:
        raise RuntimeError(f"{check['files']} files landed in {dest}, expected {landed['chunks']}")
    if versions.exists(spark, join_path(dest, CONTENT)):
        verify_content(spark, dest)


def concurrently(spark: SparkSession, steps: dict) -> dict:
    """Run independent Spark jobs from driver threads so their tasks share the cluster.

    Used for the three raw datasets and the three dimensions, which do not
    depend on each other (the source pipeline also loads them in parallel).
    The first failure is raised after all steps finished.
    """
    if len(steps) <= 1:
        return {k: f() for k, f in steps.items()}
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        # inherit the caller's job group, description and scheduler pool
        futures = {k: pool.submit(inheritable_thread_target(spark)(f)) for k, f in steps.items()}
        return {k: fut.result() for k, fut in futures.items()}


def land_source(
    spark: SparkSession,
    dataset: str,
    source: str,
    raw_root: str,
    records_per_file: int | None = None,
    load: str | None = None,
    verify: bool = True,
    multi_line: bool = True,
    bad_records: str | None = None,
    one_task: bool = False,
    own_source: bool = False,
) -> dict[str, int]:
    """Land one source CSV file (or folder) into the raw zone in file order (K6, K8, T7).

    With ``load`` (e.g. ``2024-05``) the chunks go to ``<folder>/load=<load>/``
    and earlier loads stay in place, for incremental refreshes; without it the
    dataset folder is replaced.

    All source columns are kept. The source is parsed with the dataset's real
    delimiter and the RFC-4180 dialect, in ``FAILFAST`` mode, so a malformed
    record stops the load instead of truncating it silently; with a folder
    ``bad_records`` such records are written there as text, counted as ``bad``,
    and the others are landed.

    Records may hold line breaks. A file is still read by many tasks: its splits are brought in line with its records
    (:mod:`crashlake.sources.records`). ``multi_line=False`` spares that work where no record holds a line break;
    ``one_task`` reads each file in one task with Spark's own ``multiLine`` source. With ``own_source`` the source is
    scratch of the caller's, who can make it again: where splits are read it goes as soon as its lines are staged, so that
    it does not lie on the disk beside the chunks.
    """
    n = DEFAULT_CHUNK_RECORDS[dataset] if records_per_file is None else records_per_file
    if n <= 0:
        raise ValueError("records_per_file must be > 0")
    with shuffles_removed(spark):
        sep, dest = RAW_DELIMITERS[dataset], _raw_dest(raw_root, dataset, load)
        aligned = multi_line and not one_task
        if aligned:
            mode = {"mode": "PERMISSIVE", "corrupt": "_corrupt_record"} if bad_records else {}
            df = read_csv_records(spark, source, sep, own=own_source, **mode)
            schema, lines = df.schema, df.scratch
        else:
            df = read_csv(spark, source, sep=sep, multi_line=multi_line)
            schema = T.StructType([*df.schema.fields, T.StructField("_corrupt_record", T.StringType())])
            lines = None
        bad = {}
        if bad_records:
            if not aligned:
                df = read_csv(spark, source, sep=sep, schema=schema, mode="PERMISSIVE", multi_line=multi_line)
            # all columns are written first: the parser only knows a record is bad when it parses all of them
            aside = scratch_path(spark, "bad_records")
            bad = {"bad": write_table(df.where(F.col("_corrupt_record").isNotNull()), aside)}
            spark.read.schema(schema).parquet(aside).select("_corrupt_record").write.mode("overwrite").text(bad_records)
            df = df.where(F.col("_corrupt_record").isNull())
        order = ORDER if aligned else None
        out = land_chunked_csv(df, dest, n, order_by=order, sep=sep, drop=["_corrupt_record", *(order or [])], until_staged=lines)
        if verify:
            _verify_landed(spark, dest, out)
        return {**out, **bad}


def raw_file_count(spark: SparkSession, raw_root: str, expected: int | None = None) -> DataFrame:
    """Number of landed CSV files (Q5): a file listing, contents are never read.

    With ``expected`` a ``passed`` column tells whether the count matches.
    """
    files = file_inventory(spark, raw_root, "*.csv").agg(F.count(F.lit(1)).alias("files"))
    if expected is None:
        return files
    return files.withColumn("passed", F.col("files") == F.lit(expected))


@dataclass
class LakeBuild:
    lake_root: str
    rows: dict[str, int] = field(default_factory=dict)


def _airports(spark: SparkSession, raw_root: str, version: str, continent: str, country: str) -> int:
    raw = read_raw_dataset(spark, raw_root, "airports", columns=AIRPORT_RAW_COLUMNS)
    return write_table(transforms.build_airports(raw, continent, country), join_path(version, "airports"), ["state"])


def city_register(lake_root: str) -> str:
    """Table (city_name, state_name, city_id) of all cities the lake ever had; outlives its versions."""
    return join_path(lake_root, "_keys", "cities")


def _cities(spark: SparkSession, raw_root: str, lake_root: str, version: str) -> int:
    found = transforms.distinct_cities(read_raw_dataset(spark, raw_root, "cities", columns=CITY_RAW_COLUMNS))
    keyed = lasting_ids(found, transforms.CITY_KEY, city_register(lake_root), "city_id")
    return write_table(transforms.city_table(keyed), join_path(version, "cities"), cluster_by=["city_id"])


def _stage_and_weather(spark: SparkSession, raw_root: str, version: str) -> tuple[DataFrame, dict[str, int]]:
    """Parse the raw accidents once into a typed staging table, then build the weather dimension (T3) from it."""
    raw = read_raw_dataset(spark, raw_root, "accidents", columns=ACCIDENT_RAW_COLUMNS)
    typed = transforms.typed_accidents(raw)
    staging = staging_path(spark, version, "accidents_typed")
    rows = write_table(typed, staging)
    staged = spark.read.schema(typed.schema).parquet(staging)
    weather = write_table(transforms.weather_from_typed(staged), join_path(version, "weather_conditions"))
    return staged, {"raw_accidents": rows, "weather_conditions": weather}


def _fact(spark: SparkSession, staged: DataFrame, cities: DataFrame, version: str) -> int:
    fact = transforms.fact_from_typed(staged, cities, read_table(spark, version, "weather_conditions"))
    return write_table(fact, join_path(version, "accidents"), ["year", "month"], cluster_by=["city_id"])


def build_airports_table(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    continent: str = transforms.DEFAULT_CONTINENT,
    country: str = transforms.DEFAULT_COUNTRY,
) -> int:
    """Airports job (T1): raw airports -> ``airports`` partitioned by state."""
    version = versions.new_version(spark, lake_root)
    rows = _airports(spark, raw_root, version, continent, country)
    versions.complete(spark, version)
    return rows


def build_cities_table(spark: SparkSession, raw_root: str, lake_root: str) -> int:
    """Cities job (T2): raw cities -> ``cities``. Known cities keep their ids, so the accidents stay right; those that
    were left out for want of a city come in with ``refresh_dimensions``."""
    version = versions.new_version(spark, lake_root)
    rows = _cities(spark, raw_root, lake_root, version)
    versions.complete(spark, version)
    return rows


def build_accidents_tables(spark: SparkSession, raw_root: str, lake_root: str) -> dict[str, int]:
    """Accidents job (T3 + T4): weather dimension and fact, in one version. Needs the cities table in the lake."""
    version = versions.new_version(spark, lake_root)
    staged, rows = _stage_and_weather(spark, raw_root, version)
    rows["accidents"] = _fact(spark, staged, read_table(spark, lake_root, "cities"), version)
    rows["dropped_no_city"] = rows["raw_accidents"] - rows["accidents"]
    versions.complete(spark, version)
    return rows


def build_lake(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    continent: str = transforms.DEFAULT_CONTINENT,
    country: str = transforms.DEFAULT_COUNTRY,
) -> LakeBuild:
    """Build the four curated tables in dependency order (T5) as a new version of the lake.

    The raw accident CSV is parsed once: its typed rows are written to a
    staging table in the shared folder, from which both the weather dimension
    (one column) and the fact are built. Staging, airports and cities are
    independent and run concurrently; the fact waits for all dimensions.
    Readers move to the new version when all four tables are written; a build
    that fails before changes nothing. Counts of the load report (K5) are
    those of the written files.
    """
    build = LakeBuild(lake_root)
    version = versions.new_version(spark, lake_root)
    done = concurrently(
        spark,
        {
            "airports": lambda: _airports(spark, raw_root, version, continent, country),
            "cities": lambda: _cities(spark, raw_root, lake_root, version),
            "staged": lambda: _stage_and_weather(spark, raw_root, version),
        }
    )
    staged, rows = done.pop("staged")
    build.rows.update(done)
    build.rows.update(rows)
    build.rows["accidents"] = _fact(spark, staged, read_table(spark, version, "cities"), version)
    build.rows["dropped_no_city"] = build.rows["raw_accidents"] - build.rows["accidents"]
    versions.complete(spark, version)
    return build


PARTIALS = "counts_by_month"
_SEEN = "counts_of"


def build_marts(spark: SparkSession, lake_root: str, marts_root: str) -> dict[str, int]:
    """Pre-aggregated marts (A7-A9, V4) as flat Parquet tables, built from the whole fact.

    The fact is read once, into counts per (city, airport, weather, month), kept as the table ``counts_by_month``;
    the marts are sums of those.
    """
    upto = changes.last(spark, lake_root)
    write_table(marts.counts(read_table(spark, lake_root, "accidents")), join_path(marts_root, PARTIALS), ["year", "month"])
    _remember(spark, lake_root, marts_root, upto)
    return _sum_marts(spark, lake_root, marts_root)


def refresh_marts(spark: SparkSession, lake_root: str, marts_root: str) -> dict[str, int]:
    """Bring the marts up to date with the facts replaced since they were last built or refreshed (A8, A9).

    Counts are maintained month by month: of the fact only the months noted since are read, their counts take the
    place of the old ones, and the marts are summed anew from counts. A month that has no facts any more has no counts.
    The place in the change log is remembered after the counts are written, so a run that dies is done again by the
    next. Marts of another version of the lake are built whole.
    """
    fact, seen = _remembered(spark, marts_root)
    if fact != versions.table_path(spark, lake_root, "accidents"):
        return build_marts(spark, lake_root, marts_root)
    upto = changes.last(spark, lake_root)
    months = changes.since(spark, lake_root, seen, upto)
    if months:
        path, staged = join_path(marts_root, PARTIALS), scratch_path(spark, "month_counts")
        touched = month_counts(spark, lake_root, months)
        write_table(touched, staged)
        touched = spark.read.schema(touched.schema).parquet(staged)
        there = {tuple(r) for r in touched.select("year", "month").distinct().collect()}  # some of ``months``
        write_table(touched, path, ["year", "month"], dynamic=True)
        for pair in set(months) - there:
            names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(("year", "month"), pair)]
            versions.delete(spark, join_path(path, *names))
        _remember(spark, lake_root, marts_root, upto)
    return _sum_marts(spark, lake_root, marts_root)


def month_counts(spark: SparkSession, lake_root: str, months: list[tuple]) -> DataFrame:
    """Counts of the facts of some months: the only scan of the fact in a refresh of the marts."""
    return marts.counts(read_table(spark, lake_root, "accidents").where(changes.in_months(months)))


def _remember(spark: SparkSession, lake_root: str, marts_root: str, number: int) -> None:
    """Note of which fact the counts are, and up to which change."""
    fact = versions.table_path(spark, lake_root, "accidents")
    row = spark.range(1).select(F.lit(fact).alias("fact"), F.lit(number).cast("long").alias("number"))
    write_table(row, join_path(marts_root, _SEEN))


def _remembered(spark: SparkSession, marts_root: str) -> tuple[str | None, int]:
    path = join_path(marts_root, _SEEN)
    return tuple(spark.read.parquet(path).head()) if versions.exists(spark, join_path(path, "_SUCCESS")) else (None, 0)


def _sum_marts(spark: SparkSession, lake_root: str, marts_root: str) -> dict[str, int]:
    schema = "city_id long, airport_code string, weather_condition_id long, n long, year int, month int"
    counts = spark.read.schema(schema).parquet(join_path(marts_root, PARTIALS))
    t = {name: read_table(spark, lake_root, name) for name in ("cities", "weather_conditions")}
    frames = {
        "by_city": marts.by_city(counts, t["cities"]),
        "by_airport": marts.by_airport(counts),
        "by_weather": marts.by_weather(counts, t["weather_conditions"]),
        "by_state": marts.accidents_by_state(counts, t["cities"]),
        "by_month": marts.by_month(counts),
    }
    writes = {name: (lambda n=name: write_table(frames[n], join_path(marts_root, n))) for name in frames}
    return concurrently(spark, writes)


def refresh_lake(
    spark: SparkSession, raw_root: str, lake_root: str, marts_root: str | None = None, load: str | None = None
) -> dict[str, int]:
    """Fold raw accidents (one load, or all that is landed) into the lake, then bring the marts up to date (A8, A9).

    An upsert by accident and month: running it again changes nothing.
    """
    from crashlake.streaming import refresh_batch

    folder = _raw_dest(raw_root, "accidents", load)
    refresh_batch(spark, read_csv(spark, folder, sep=RAW_DELIMITERS["accidents"]), lake_root)
    return refresh_marts(spark, lake_root, marts_root) if marts_root else {}


LATE = "_late_cities"


def refresh_dimensions(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    marts_root: str | None = None,
    continent: str = transforms.DEFAULT_CONTINENT,
    country: str = transforms.DEFAULT_COUNTRY,
) -> dict[str, int]:
    """Bring airports and cities up to date with all that is landed, without building the accidents anew.

    Cities keep their ids. The pairs (name, state code) that are new are noted in ``_late_cities`` before readers see
    them; landed accidents that were left out for want of them are then folded in like a refresh, and the note
    goes. A run that dies in between leaves the note to the next.
    """
    from crashlake.streaming import refresh_batch

    pair = ["city_name", "state_code"]
    before = read_table(spark, lake_root, "cities").select(*pair)
    version, late = versions.new_version(spark, lake_root), join_path(lake_root, LATE)
    rows = concurrently(
        spark,
        {
            "airports": lambda: _airports(spark, raw_root, version, continent, country),
            "cities": lambda: _cities(spark, raw_root, lake_root, version),
        },
    )
    schema = LAKE_TABLES["cities"][0]
    now = spark.read.schema(schema).parquet(join_path(version, "cities")).select(*pair)
    write_table(now.join(before, pair, "left_anti"), late, mode="append")
    versions.complete(spark, version)
    waiting = spark.read.schema(now.schema).parquet(late).distinct()
    gained = {"accidents": 0, "weather_conditions": 0}
    if not waiting.isEmpty():
        raw = read_raw_dataset(spark, raw_root, "accidents", columns=ACCIDENT_RAW_COLUMNS)
        gained = refresh_batch(spark, raw, lake_root, of_cities=waiting)
    versions.delete(spark, late)
    if marts_root:
        refresh_marts(spark, lake_root, marts_root)
    return {**rows, "late_accidents": gained["accidents"]}


def lake_tables(spark: SparkSession, lake_root: str) -> dict[str, DataFrame]:
    return {t: read_table(spark, lake_root, t) for t in ("accidents", "cities", "airports", "weather_conditions")}


def check_lake(
    spark: SparkSession,
    lake_root: str,
    airport_code_length: int = 4,
    state_code_pattern: str = "^[A-Z]{2}$",
    raw_root: str | None = None,
) -> DataFrame:
    """Full data-quality report of a built lake (T6, Q1-Q11).

    A table whose folder is missing is reported as empty instead of raising.
    With ``raw_root`` the raw zone is profiled too (Q6, Q7, P6): missing values of
    every accident column, values that do not parse, and duplicated (City, State)
    keys of the city source - reported, not failed.
    """
    names = ("accidents", "cities", "airports", "weather_conditions")
    there = {name: versions.exists(spark, versions.table_path(spark, lake_root, name)) for name in names}
    t = {name: read_table(spark, lake_root, name) if there[name] else None for name in names}
    parts = []
    for name, df in t.items():
        if df is None:
            parts.append(
                spark.createDataFrame(
                    [("non_empty", name, 0, False)], "check_name string, table_name string, observed bigint, passed boolean"
                )
            )
    acc = t["accidents"]
    if acc is not None:
        fact_checks = [
            quality.non_empty_check(),
            quality.range_check("severity", 1, 4, "severity_range"),
            quality.length_check("airport_code", airport_code_length, "airport_code_format"),
            # unparseable start times land in the null partition; reported, not failed
            quality.null_check("datetime", "datetime_nulls", rule="report"),
            quality.null_check("weather_condition_id", "weather_nulls", rule="report"),
            quality.null_check("airport_code", "airport_code_nulls", rule="report"),
        ]
        refs = [
            (name, fk, t[dim], pk)
            for name, fk, dim, pk in (
                ("airport", "airport_code", "airports", "airport_code"),
                ("city", "city_id", "cities", "city_id"),
                ("weather", "weather_condition_id", "weather_conditions", "weather_condition_id"),
            )
            if t[dim] is not None
        ]
        # Unknown airports are expected (the fact keeps codes as reported): reported, not failed.
        rules = {"airport": "report"}
        # one scan of the fact for the column checks and every reference
        hits = quality.with_reference_hits(acc, refs)
        orphan_checks = [quality.orphan_check(name, fk, rules.get(name, "zero")) for name, fk, _, _ in refs]
        parts.append(quality.table_checks(hits, "accidents", fact_checks + orphan_checks))
        parts.append(quality.key_check(acc, "accidents", ["accident_id"]))
    if t["cities"] is not None:
        city_checks = [quality.non_empty_check(), quality.pattern_check("state_code", state_code_pattern, "state_code_format")]
        parts.append(quality.table_checks(t["cities"], "cities", city_checks))
        parts.append(quality.key_check(t["cities"], "cities", ["city_id"]))
        # the fact joins cities on (name, state code): it must be unique too, or the join fans out
        parts.append(quality.key_check(t["cities"], "cities", ["city_name", "state_code"], "join_key_unique"))
    if t["airports"] is not None:
        airport_checks = [
            quality.non_empty_check(),
            quality.length_check("airport_code", airport_code_length, "airport_code_format"),
            quality.pattern_check("state_code", state_code_pattern, "state_code_format"),
        ]
        parts.append(quality.table_checks(t["airports"], "airports", airport_checks))
        parts.append(quality.key_check(t["airports"], "airports", ["airport_code"]))
    if t["weather_conditions"] is not None:
        parts.append(quality.table_checks(t["weather_conditions"], "weather_conditions", [quality.non_empty_check()]))
        parts.append(quality.key_check(t["weather_conditions"], "weather_conditions", ["weather_condition_id"]))
    if raw_root is not None:
        parts.extend(_raw_profile(spark, raw_root))
    return quality.report(parts)


def _raw_profile(spark: SparkSession, raw_root: str) -> list[DataFrame]:
    """Q6/Q7 on the raw zone as report rows (never failing)."""
    acc = read_raw_dataset(spark, raw_root, "accidents", columns=ACCIDENT_RAW_COLUMNS)
    checks = [quality.null_check(f"`{c}`", f"missing_{c}", rule="report") for c in ACCIDENT_RAW_COLUMNS]
    parsers = {
        "Start_Time": safe_date, "Weather_Timestamp": safe_date, "Severity": safe_int, "Distance(mi)": safe_double,
        "Temperature(F)": safe_double, "Wind_Speed(mph)": safe_double, "Precipitation(in)": safe_double,
    }
    checks += [quality.cast_check(c, parse(c)) for c, parse in parsers.items()]
    columns = quality.table_checks(acc, "raw_accidents", checks)
    cities = transforms.typed_cities(read_raw_dataset(spark, raw_root, "cities", columns=CITY_RAW_COLUMNS))
    dups = quality.duplicate_profile(cities, ["city_name", "state_name"], "total_population").agg(
        F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("variants") > 1, 1)).alias("conflicting")
    )
    dup_rows = dups.select(
        F.inline(
            F.array(
                F.struct(F.lit("duplicate_keys").alias("check_name"), F.col("keys").alias("observed")),
                F.struct(F.lit("conflicting_duplicates").alias("check_name"), F.col("conflicting").alias("observed")),
            )
        )
    ).select("check_name", F.lit("raw_cities").alias("table_name"), "observed", F.lit(True).alias("passed"))
    return [columns, dup_rows]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="crashlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("land", help="split a source CSV into record-bounded chunks in the raw zone")
    ld.add_argument("dataset", choices=sorted(RAW_FOLDERS))
    ld.add_argument("source")
    ld.add_argument("raw_root")
    ld.add_argument("--records", type=int, default=None)
    ld.add_argument("--single-line", action="store_true", help="no record holds a line break: read large files in parallel")
    ld.add_argument("--load", default=None, help="land next to earlier loads under load=<name>/ (incremental)")
    r = sub.add_parser("refresh", help="fold newly landed accident chunks into the lake, then rebuild the marts")
    r.add_argument("raw_root")
    r.add_argument("lake_root")
    r.add_argument("marts_root")
    r.add_argument("--load", default=None, help="fold in this load only (default: all that is landed)")
    d = sub.add_parser("refresh-dimensions", help="bring airports and cities up to date; accidents of new cities come in")
    d.add_argument("raw_root")
    d.add_argument("lake_root")
    d.add_argument("marts_root")
    m = sub.add_parser("marts", help="rebuild the Parquet marts from the lake")
    m.add_argument("lake_root")
    m.add_argument("marts_root")
    b = sub.add_parser("build", help="build the lake from a landed raw zone")
    b.add_argument("raw_root")
    b.add_argument("lake_root")
    b.add_argument("--table", choices=["all", "airports", "cities", "accidents"], default="all",
                   help="build one table job only (accidents needs cities already built)")
    c = sub.add_parser("check", help="write the data-quality report and fail on a failed check")
    c.add_argument("lake_root")
    c.add_argument("report_path")
    c.add_argument("--raw-root", default=None, help="also profile the raw zone (missing values, duplicate keys)")
    args = ap.parse_args(argv)
    # Master and cluster settings come from spark-submit (or the defaults of a local run).
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName(f"crashlake-{args.cmd}").getOrCreate()
    if args.cmd == "land":
        print(land_source(spark, args.dataset, args.source, args.raw_root, args.records, args.load, multi_line=not args.single_line))
    elif args.cmd == "refresh":
        print(refresh_lake(spark, args.raw_root, args.lake_root, args.marts_root, args.load))
    elif args.cmd == "refresh-dimensions":
        print(refresh_dimensions(spark, args.raw_root, args.lake_root, args.marts_root))
    elif args.cmd == "marts":
        print(build_marts(spark, args.lake_root, args.marts_root))
    elif args.cmd == "build":
        one = {
            "airports": lambda: build_airports_table(spark, args.raw_root, args.lake_root),
            "cities": lambda: build_cities_table(spark, args.raw_root, args.lake_root),
            "accidents": lambda: build_accidents_tables(spark, args.raw_root, args.lake_root),
        }
        print(build_lake(spark, args.raw_root, args.lake_root).rows if args.table == "all" else one[args.table]())
    else:
        path = args.report_path
        write_table(check_lake(spark, args.lake_root, raw_root=args.raw_root), path)
        failed = spark.read.parquet(path).filter(~F.col("passed")).collect()  # a row per check
        if failed:
            raise SystemExit(f"data-quality checks failed: {[tuple(r) for r in failed]}")


if __name__ == "__main__":
    main()
