"""Surrogate keys outlive builds; cities that arrive late bring their accidents with them."""

import pytest
from pyspark.sql import functions as F

from crashlake.operators.lasting import lasting_ids
from crashlake.plans import jobs
from crashlake.sources import read_table
from tests.conftest import ACCIDENT_HEADER, ACCIDENTS, AIRPORTS, CITIES, write_csv_file

SCHEMA = "k string, v int"


def _ids(spark, rows, register, key=("k",)):
    df = spark.createDataFrame(rows, SCHEMA)
    return {tuple(r[c] for c in key): r["id"] for r in lasting_ids(df, list(key), register, "id").collect()}


def test_ids_last_and_new_keys_follow_the_largest(spark, tmp_path):
    register = str(tmp_path / "register")
    assert _ids(spark, [("b", 1), (None, 2), ("c", 3)], register) == {(None,): 0, ("b",): 1, ("c",): 2}
    assert _ids(spark, [("c", 9), ("a", 1), ("d", 1), (None, 1)], register) == {(None,): 0, ("c",): 2, ("a",): 3, ("d",): 4}
    assert _ids(spark, [("b", 1)], register) == {("b",): 1}  # back again
    assert _ids(spark, [], register) == {}
    assert spark.read.parquet(register).count() == 5


def test_composite_keys_with_nulls(spark, tmp_path):
    register = str(tmp_path / "register")
    rows = [("x", None), (None, None), (None, 1), ("x", 1)]
    first = _ids(spark, rows, register, ("k", "v"))
    assert first == {(None, None): 0, (None, 1): 1, ("x", None): 2, ("x", 1): 3}
    assert _ids(spark, [*rows, ("a", 0)], register, ("k", "v")) == {**first, ("a", 0): 4}


def test_an_append_seen_in_part_gives_no_id_twice(spark, tmp_path):
    register = str(tmp_path / "register")
    spark.createDataFrame([("a", 0), ("c", 2)], "k string, id long").write.parquet(register)
    assert _ids(spark, [("a", 1), ("b", 1), ("c", 1)], register) == {("a",): 0, ("c",): 2, ("b",): 3}


def test_ids_do_not_depend_on_partitions(spark, tmp_path):
    df = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(0).alias("v"))
    early = df.where(F.col("k") > "8")
    found = []
    for n in (1, 7):
        register = str(tmp_path / f"register{n}")
        lasting_ids(early.repartition(n), ["k"], register, "id")
        found.append(sorted(map(tuple, lasting_ids(df.repartition(n), ["k"], register, "id").select("k", "id").collect())))
    assert found[0] == found[1]
    assert sorted(i for _, i in found[0]) == list(range(2000))
    keys = {k for k, _ in found[0]}
    assert [k for k, _ in sorted(found[0], key=lambda x: x[1])] == sorted(k for k in keys if k > "8") + sorted(k for k in keys if k <= "8")


def _zone(root, cities=CITIES, accidents=ACCIDENTS):
    write_csv_file(f"{root}/airport_data/a.csv", ["ident", "type", "name", "continent", "iso_country", "iso_region", "municipality"], AIRPORTS)
    _land_cities(root, 1, cities)
    write_csv_file(f"{root}/accident_data/load=1/chunk=0/part.csv", ACCIDENT_HEADER, accidents)


def _land_cities(root, load, rows):
    write_csv_file(f"{root}/city_data/load={load}/chunk=0/c.csv", ["City", "State", "State Code", "Total Population"], rows, sep=";")


def _city_ids(spark, lake):
    return {(r["city_name"], r["state_code"]): r["city_id"] for r in read_table(spark, lake, "cities").collect()}


def _facts(spark, lake):
    c = read_table(spark, lake, "cities").select("city_id", "city_name")
    return sorted((r["accident_id"], r["city_name"]) for r in read_table(spark, lake, "accidents").join(c, "city_id").collect())


KANSAS = [("Smallville", "Kansas", "KS", "45001"), ("Abilene", "Kansas", "KS", "6844")]


@pytest.fixture
def late(spark, tmp_path):
    """Lake of five facts, whose raw zone then gets two cities, one of which sorts first and one of which was missed."""
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _zone(raw)
    jobs.build_lake(spark, raw, lake)
    before = _city_ids(spark, lake)
    assert sorted(before.values()) == [0, 1, 2, 3] and len(_facts(spark, lake)) == 5
    _land_cities(raw, 2, KANSAS)
    return raw, lake, before


EXPECTED = [("A-1", "Dayton"), ("A-2", "Dayton"), ("A-3", "Los Angeles"), ("A-4", "Springfield"), ("A-5", "Smallville"), ("A-6", "Springfield")]


def test_a_city_that_sorts_first_changes_no_id(spark, late, tmp_path):
    raw, lake, before = late
    marts_root = str(tmp_path / "marts")
    jobs.build_marts(spark, lake, marts_root)
    jobs.main(["refresh-dimensions", raw, lake, marts_root])
    assert _city_ids(spark, lake) == {**before, ("Abilene", "KS"): 4, ("Smallville", "KS"): 5}
    assert _facts(spark, lake) == EXPECTED
    by_state = {r["state"]: r["accident_count"] for r in spark.read.parquet(f"{marts_root}/by_state").collect()}
    assert by_state == {"OH": 3, "CA": 1, "IL": 1, "KS": 1}
    assert jobs.refresh_dimensions(spark, raw, lake)["late_accidents"] == 0  # again: nothing new
    assert _facts(spark, lake) == EXPECTED


def test_the_cities_job_alone_leaves_the_facts_right(spark, late):
    raw, lake, before = late
    facts = _facts(spark, lake)
    jobs.build_cities_table(spark, raw, lake)
    assert before.items() <= _city_ids(spark, lake).items() and _facts(spark, lake) == facts


def test_a_full_build_keeps_the_ids(spark, late):
    raw, lake, before = late
    jobs.build_lake(spark, raw, lake)
    assert before.items() <= _city_ids(spark, lake).items() and _facts(spark, lake) == EXPECTED


def test_a_run_that_dies_before_the_facts_is_made_up(spark, late, monkeypatch):
    import crashlake.streaming

    raw, lake, before = late

    def dies(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(crashlake.streaming, "refresh_batch", dies)
        with pytest.raises(RuntimeError):
            jobs.refresh_dimensions(spark, raw, lake)
    assert len(_city_ids(spark, lake)) == 6 and len(_facts(spark, lake)) == 5
    assert jobs.refresh_dimensions(spark, raw, lake)["late_accidents"] == 1
    assert _facts(spark, lake) == EXPECTED


def test_late_accidents_keep_their_last_row(spark, late):
    raw, lake, _ = late
    place = {c: ACCIDENT_HEADER.index(c) for c in ("ID", "City", "State")}

    def moved(row, id_, city, state):
        row = list(row)
        row[place["ID"]], row[place["City"]], row[place["State"]] = id_, city, state
        return row

    # B-1 was first reported in Smallville, then in Dayton; B-2 the other way round
    rows = [moved(ACCIDENTS[4], "B-1", "Smallville", "KS"), moved(ACCIDENTS[4], "B-2", "Dayton", "OH")]
    write_csv_file(f"{raw}/accident_data/load=2/chunk=0/part.csv", ACCIDENT_HEADER, rows)
    rows = [moved(ACCIDENTS[4], "B-1", "Dayton", "OH"), moved(ACCIDENTS[4], "B-2", "Smallville", "KS")]
    write_csv_file(f"{raw}/accident_data/load=10/chunk=0/part.csv", ACCIDENT_HEADER, rows)
    jobs.refresh_lake(spark, raw, lake)
    jobs.refresh_dimensions(spark, raw, lake)
    assert _facts(spark, lake) == sorted([*EXPECTED, ("B-1", "Dayton"), ("B-2", "Smallville")])
