"""Incremental refresh: new raw chunks are folded into the lake exactly once."""

from pyspark.sql import functions as F

from crashlake.plans import jobs, marts
from crashlake.sources import read_raw_dataset, read_table
from crashlake.streaming import accident_refresh, refresh_batch
from tests.conftest import ACCIDENT_HEADER, ACCIDENTS, AIRPORTS, CITIES, write_csv_file


def _raw_zone(root):
    write_csv_file(f"{root}/airport_data/a.csv", ["ident", "type", "name", "continent", "iso_country", "iso_region", "municipality"], AIRPORTS)
    write_csv_file(f"{root}/city_data/c.csv", ["City", "State", "State Code", "Total Population"], CITIES, sep=";")
    write_csv_file(f"{root}/accident_data/load=1/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[:3])


def test_refresh_folds_new_chunks_once(spark, tmp_path):
    raw, lake, ckpt = str(tmp_path / "raw"), str(tmp_path / "lake"), str(tmp_path / "ckpt")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    assert read_table(spark, lake, "accidents").count() == 3

    accident_refresh(spark, raw, lake, ckpt).awaitTermination()  # replays load 1: nothing new
    assert read_table(spark, lake, "accidents").count() == 3

    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[3:])
    accident_refresh(spark, raw, lake, ckpt).awaitTermination()
    acc = read_table(spark, lake, "accidents")
    assert sorted(r[0] for r in acc.select("accident_id").collect()) == ["A-1", "A-2", "A-3", "A-4", "A-6"]
    weather = {r["condition"]: r["weather_condition_id"] for r in read_table(spark, lake, "weather_conditions").collect()}
    assert weather == {None: 0, "Clear": 1, "Rain": 2, "Fog": 3}  # Fog appended after the current maximum
    by_weather = sorted((r["condition"] or "", r["n"]) for r in marts.by_weather(acc, read_table(spark, lake, "weather_conditions")).collect())
    assert by_weather == [("", 1), ("Clear", 2), ("Rain", 2)]

    accident_refresh(spark, raw, lake, ckpt).awaitTermination()  # nothing pending
    assert read_table(spark, lake, "accidents").count() == 5


def test_replayed_batch_is_idempotent(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[3:])
    batch = read_raw_dataset(spark, raw, "accidents")
    first = refresh_batch(spark, batch, lake)
    second = refresh_batch(spark, batch, lake)
    assert first["accidents"] == 2 and second == {"weather_conditions": 0, "accidents": 0}
    acc = read_table(spark, lake, "accidents")
    assert acc.count() == 5 and acc.select("accident_id").distinct().count() == 5
    assert read_table(spark, lake, "weather_conditions").filter(F.col("condition").isNull()).count() == 1


def test_refresh_job_updates_marts(spark, tmp_path):
    raw, lake, marts_root = (str(tmp_path / n) for n in ("raw", "lake", "marts"))
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    src = tmp_path / "later.csv"
    write_csv_file(str(src), ACCIDENT_HEADER, ACCIDENTS[3:])
    jobs.main(["land", "accidents", str(src), raw, "--load", "2"])
    jobs.main(["refresh", raw, lake, marts_root, "--load", "2"])
    by_state = {r["state"]: r["accident_count"] for r in spark.read.parquet(f"{marts_root}/by_state").collect()}
    assert by_state == {"OH": 3, "CA": 1, "IL": 1}


def _facts(spark, lake):
    return sorted(r[0] for r in read_table(spark, lake, "accidents").select("accident_id").collect())


def test_refreshing_again_changes_nothing(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[3:])
    for _ in range(3):
        jobs.refresh_lake(spark, raw, lake)
        assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4", "A-6"]
    accident_refresh(spark, raw, lake, str(tmp_path / "new_checkpoint")).awaitTermination()
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4", "A-6"]


def test_landing_the_same_source_anew_does_not_double_the_fact(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    src = str(tmp_path / "again.csv")
    write_csv_file(src, ACCIDENT_HEADER, ACCIDENTS[:3])
    jobs.land_source(spark, "accidents", src, raw)
    jobs.refresh_lake(spark, raw, lake)
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3"]


def test_a_later_row_of_an_accident_replaces_the_earlier(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    changed = list(ACCIDENTS[0])
    changed[ACCIDENT_HEADER.index("Severity")] = "1"
    no_id = list(ACCIDENTS[1])
    no_id[0] = None
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, [changed, no_id])
    for _ in range(2):
        jobs.refresh_lake(spark, raw, lake, load="2")
    rows = {r["accident_id"]: r["severity"] for r in read_table(spark, lake, "accidents").collect()}
    assert rows == {"A-1": 1, "A-2": 2, "A-3": 2, None: 2}


def test_a_refresh_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    from crashlake.streaming import refresh

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[3:])
    put, calls = refresh._put_pending, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return put(*args)

    monkeypatch.setattr(refresh, "_put_pending", dies)
    try:
        jobs.refresh_lake(spark, raw, lake, load="2")
    except RuntimeError:
        pass
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3"]
    monkeypatch.setattr(refresh, "_put_pending", put)
    jobs.refresh_lake(spark, raw, lake, load="2")
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4", "A-6"]


def test_only_the_months_of_the_batch_are_read(spark, tmp_path):
    import contextlib
    import io

    from crashlake.streaming import refresh

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    df = read_table(spark, lake, "accidents").where(refresh._in_months([(2016, 5), (None, None)]))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "PartitionFilters: [((" in buf.getvalue()
    assert sorted(r[0] for r in df.select("accident_id").collect()) == ["A-1", "A-2"]


def test_a_build_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    before = sorted(map(tuple, marts.by_weather(read_table(spark, lake, "accidents"), read_table(spark, lake, "weather_conditions")).collect()), key=str)
    more = [list(ACCIDENTS[3])]
    more[0][ACCIDENT_HEADER.index("Weather_Condition")] = "Aaa"  # would renumber the conditions
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, more)
    write = jobs.write_table

    def no_fact(df, path, *args, **kwargs):
        if path.endswith("/accidents"):
            raise RuntimeError("disk full")
        return write(df, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "write_table", no_fact)
    try:
        jobs.build_lake(spark, raw, lake)
    except RuntimeError:
        pass
    monkeypatch.setattr(jobs, "write_table", write)
    t = jobs.lake_tables(spark, lake)
    assert sorted(map(tuple, marts.by_weather(t["accidents"], t["weather_conditions"]).collect()), key=str) == before
    jobs.refresh_lake(spark, raw, lake)  # the file of the failed build is not skipped
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4"]
    jobs.build_lake(spark, raw, lake)
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4"]
    from crashlake import versions
    from crashlake.schemas import LAKE_TABLES

    assert len(versions.drop_old_versions(spark, lake, list(LAKE_TABLES), keep=1)) == 2
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4"]


def _changed(row, **values):
    row = list(row)
    for name, value in values.items():
        row[ACCIDENT_HEADER.index(name)] = value
    return row


def _severity(spark, lake):
    return {r["accident_id"]: r["severity"] for r in read_table(spark, lake, "accidents").collect()}


def test_the_last_chunk_load_and_record_win(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    land = lambda where, *rows: write_csv_file(f"{raw}/accident_data/{where}/part.csv", ACCIDENT_HEADER, list(rows))
    land("load=2/chunk=10", _changed(ACCIDENTS[0], Severity="4"))
    land("load=2/chunk=9", _changed(ACCIDENTS[0], Severity="1"), _changed(ACCIDENTS[2], Severity="4"))
    land("load=10/chunk=0", _changed(ACCIDENTS[1], Severity="4", Description="a"), _changed(ACCIDENTS[1], Severity="1", Description="z"),
         _changed(ACCIDENTS[1], Severity="3", Description="b"))
    land("load=9/chunk=0", _changed(ACCIDENTS[1], Severity="2"), _changed(ACCIDENTS[2], Severity="1"))
    for _ in range(2):
        jobs.refresh_lake(spark, raw, lake)
        assert _severity(spark, lake) == {"A-1": 4, "A-2": 3, "A-3": 1}


def test_order_holds_across_batches(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    for load, severity in (("10", "4"), ("2", "1"), ("9", "3")):  # the last load comes first
        write_csv_file(f"{raw}/accident_data/load={load}/chunk=0/part.csv", ACCIDENT_HEADER, [_changed(ACCIDENTS[0], Severity=severity)])
        jobs.refresh_lake(spark, raw, lake, load=load)
        assert _severity(spark, lake)["A-1"] == 4
    # the chunk is landed anew: it comes when the first one came
    write_csv_file(f"{raw}/accident_data/load=10/chunk=0/part.csv", ACCIDENT_HEADER, [_changed(ACCIDENTS[0], Severity="2")])
    jobs.refresh_lake(spark, raw, lake, load="10")
    assert _severity(spark, lake)["A-1"] == 2


def test_arrival_compares_numbers_as_numbers(spark):
    from crashlake.streaming.refresh import arrival

    uid = "0a1b2c3d-0000-4000-8000-00112233445"
    paths = ["f:/x/load=9/chunk=2/part-00000-%s1.c000.csv" % uid, "f:/x/load=9/chunk=10/part-00000-%s0.c000.csv" % uid, "f:/x/load=9/chunk=00011/p.csv",
             "f:/x/load=10/chunk=0/p.csv", "f:/x/load=100000000000000000000000/chunk=0/p.csv"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    assert [r["i"] for r in df.orderBy(arrival(F.col("p")).getField("chunk")).collect()] == list(range(5))


def _marts(spark, root):
    names = ("by_city", "by_airport", "by_weather", "by_state", "by_month")
    return {n: sorted(map(tuple, spark.read.parquet(f"{root}/{n}").collect()), key=str) for n in names}


def test_refreshed_marts_equal_a_full_build(spark, tmp_path, monkeypatch):
    raw, lake, marts_root = (str(tmp_path / n) for n in ("raw", "lake", "marts"))
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    jobs.build_marts(spark, lake, marts_root)
    read, built = [], []
    counts, build = jobs.month_counts, jobs.build_marts
    monkeypatch.setattr(jobs, "month_counts", lambda s, l, months: read.append(set(months)) or counts(s, l, months))
    monkeypatch.setattr(jobs, "build_marts", lambda *a: built.append(a) or build(*a))
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[3:4])
    write_csv_file(f"{raw}/accident_data/load=3/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[4:] + [_changed(ACCIDENTS[0], Airport_Code="KLAX")])
    accident_refresh(spark, f"{raw}", lake, str(tmp_path / "ckpt"), max_files_per_trigger=1).awaitTermination()  # without marts
    jobs.refresh_marts(spark, lake, marts_root)
    jobs.refresh_lake(spark, raw, lake, marts_root, load="3")
    jobs.refresh_marts(spark, lake, marts_root)  # nothing new
    assert not built and read == [{(2016, 5), (2016, 6), (2017, 5), (None, None)}, {(2016, 5), (None, None)}]
    build(spark, lake, str(tmp_path / "whole"))
    assert _marts(spark, marts_root) == _marts(spark, str(tmp_path / "whole"))
    jobs.build_lake(spark, raw, lake)  # another version: counts of the old one are of no use
    jobs.refresh_marts(spark, lake, marts_root)
    assert len(built) == 1


def test_marts_of_a_run_that_died_are_made_up(spark, tmp_path, monkeypatch):
    raw, lake, marts_root = (str(tmp_path / n) for n in ("raw", "lake", "marts"))
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    jobs.build_marts(spark, lake, marts_root)
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, ACCIDENTS[3:])
    remember = jobs._remember

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "_remember", dies)
    try:
        jobs.refresh_lake(spark, raw, lake, marts_root, load="2")
    except RuntimeError:
        pass
    monkeypatch.setattr(jobs, "_remember", remember)
    jobs.refresh_marts(spark, lake, marts_root)
    jobs.build_marts(spark, lake, str(tmp_path / "whole"))
    assert _marts(spark, marts_root) == _marts(spark, str(tmp_path / "whole"))


def test_a_month_without_facts_loses_its_counts(spark, tmp_path):
    from crashlake import changes, versions

    raw, lake, marts_root = (str(tmp_path / n) for n in ("raw", "lake", "marts"))
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    jobs.build_marts(spark, lake, marts_root)
    versions.delete(spark, versions.table_path(spark, lake, "accidents") + "/year=2016/month=6")
    changes.note(spark, lake, [(2016, 6)])
    jobs.refresh_marts(spark, lake, marts_root)
    assert _marts(spark, marts_root)["by_month"] == [(2016, 5, 2)]


def test_the_marts_refresh_reads_the_touched_months_only(spark, tmp_path):
    import contextlib
    import io

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        jobs.month_counts(spark, lake, [(2016, 5)]).explain()
    line = next(x for x in out.getvalue().splitlines() if "PartitionFilters" in x)
    assert "2016" in line and "5" in line.split("PartitionFilters")[1]


def test_micro_batches_are_folded_in_once(spark, tmp_path, monkeypatch):
    from crashlake.streaming import refresh

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    for k, severity in enumerate("431"):
        write_csv_file(f"{raw}/accident_data/load=2/chunk={k}/part.csv", ACCIDENT_HEADER, [_changed(ACCIDENTS[0], Severity=severity), ACCIDENTS[3 + k % 2]])
    put, calls = refresh._put_pending, []
    monkeypatch.setattr(refresh, "_put_pending", lambda *args: calls.append(args) or put(*args))
    query = accident_refresh(spark, raw, lake, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    query.awaitTermination()
    assert len(query.recentProgress) >= 4 and len(calls) == 2  # four micro-batches, one fold
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3", "A-4"] and _severity(spark, lake)["A-1"] == 1


def test_rows_that_a_stream_left_behind_are_folded_in_by_the_next(spark, tmp_path, monkeypatch):
    from crashlake.streaming import refresh

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_zone(raw)
    jobs.build_lake(spark, raw, lake)
    land = lambda uid, severity: write_csv_file(
        f"{raw}/accident_data/load=2/chunk=0/part-00000-0a1b2c3d-0000-4000-8000-00112233445{uid}.c000.csv", ACCIDENT_HEADER,
        [_changed(ACCIDENTS[3], Severity=severity)],
    )
    land(1, "1")
    fold = refresh._fold_incoming
    monkeypatch.setattr(refresh, "_fold_incoming", lambda *args: None)
    accident_refresh(spark, raw, lake, str(tmp_path / "ckpt")).awaitTermination()  # dies before it folds
    land(2, "3")  # the chunk is landed anew: the later one stays
    accident_refresh(spark, raw, lake, str(tmp_path / "ckpt")).awaitTermination()
    assert _facts(spark, lake) == ["A-1", "A-2", "A-3"]
    monkeypatch.setattr(refresh, "_fold_incoming", fold)
    assert refresh_batch(spark, read_raw_dataset(spark, raw, "accidents").limit(0), lake)["accidents"] == 0
    assert _severity(spark, lake)["A-4"] == 3
    accident_refresh(spark, raw, lake, str(tmp_path / "ckpt")).awaitTermination()
    assert _severity(spark, lake)["A-4"] == 3 and not refresh.versions.exists(spark, refresh._beside_fact(spark, lake, refresh.INCOMING))


def test_chunk_order_below_a_folder_is_that_of_the_whole_path(spark, tmp_path):
    from crashlake.streaming.refresh import arrival, chunk_order, chunk_order_below

    top = tmp_path / "run 07" / "raw9"
    inside = ["load=9/chunk=2/part-00000-0a1b2c3d-0000-4000-8000-001122334451.c000.csv", "load=10/chunk=007/p.csv", "12/0.csv", "p.csv"]
    uri = top.as_uri().removeprefix("file://")
    paths = [f"{begin}{uri}/{p}" for begin in ("file:", "file://") for p in inside] + ["s3a://b/raw9/load=10/chunk=3/p.csv", "", "file:/"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select("p", chunk_order(F.col("p")).alias("whole"), chunk_order_below(spark, str(top), F.col("p")).alias("below")).collect()
    assert [r["p"] for r in rows if r["whole"] != r["below"]] == []
    # rows of one chunk in the order of their micro-batches
    ten = [spark.range(1).select(arrival(F.lit("p"), n).alias("a"), F.lit(n).alias("n")) for n in (9, 10, 100)]
    assert [r["n"] for r in ten[1].union(ten[2]).union(ten[0]).orderBy("a").collect()] == [9, 10, 100]


def test_micro_batches_run_the_same_generated_code(spark, tmp_path, capsys):
    from crashlake.streaming.refresh import Arrived

    write_csv_file(str(tmp_path / "a.csv"), ACCIDENT_HEADER, ACCIDENTS)
    raw, arrived, code = spark.read.option("header", True).csv(str(tmp_path)), Arrived(), []
    for number in (1234, 5678):
        arrived(raw, number).explain("codegen")
        code.append(capsys.readouterr().out.split("Generated code:", 1)[1])
    assert code[0] == code[1]


def test_many_chunk_folders_are_listed_by_few_tasks(spark, tmp_path):
    from crashlake.sources.csv import LISTING, read_header

    sc = spark.sparkContext
    most = 4 * sc.defaultParallelism
    for k in range(most + 40):
        write_csv_file(f"{tmp_path}/raw/accident_data/load=1/chunk={k}/part.csv", ACCIDENT_HEADER, [ACCIDENTS[k % 3]])
    write_csv_file(f"{tmp_path}/raw/accident_data/load=1/_content/part.csv", ["other"], [])
    spark.conf.unset(LISTING)
    try:
        sc.setJobGroup("listing", "listing")
        schema = read_header(spark, f"{tmp_path}/raw/accident_data")
        raw = read_raw_dataset(spark, f"{tmp_path}/raw", "accidents", schema=schema)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert schema.names == ACCIDENT_HEADER and raw.count() == most + 40
    jobs_run = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("listing")]
    tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs_run for s in j.stageIds]
    assert tasks and max(tasks) <= most
    spark.conf.set(LISTING, "5000")
    read_raw_dataset(spark, f"{tmp_path}/raw", "accidents", schema=schema)
    assert spark.conf.get(LISTING) == "5000"  # the session's own setting stays
    spark.conf.unset(LISTING)
