"""Multi-line CSV read in parallel inside a file: the same records as Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from crashlake.plans import jobs
from crashlake.sources import read_csv
from crashlake.sources.records import ORDER, _ends_inside, read_csv_records
from tests.conftest import write_csv_file


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "300"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def rows_of(seed, n, sep=","):
    rng = random.Random(seed)
    pieces = ["plain", "two\nlines", 'say ""', f"a{sep}b", '"', "", None, "\n", "\n\n\n", "x" * 90, "line\r\nend", '","', ' "q" ', "é x", f'{sep}"\n"{sep}']
    return [(str(i), *(rng.choice(pieces) if rng.random() < 0.5 else rng.choice(pieces[:1]) for _ in range(3))) for i in range(n)]


def one_task(spark, path, sep):
    return [tuple(r) for r in read_csv(spark, path, sep=sep).collect()]


@pytest.mark.parametrize("sep", [",", ";"])
def test_same_records_in_file_order(spark, tmp_path, small_splits, sep):
    for k in range(3):
        write_csv_file(str(tmp_path / f"src/f{k}.csv"), ["id", "a", "b c", "d"], rows_of(k, 120 + k, sep), sep)
    got = read_csv_records(spark, str(tmp_path / "src"), sep)
    assert got.columns == ["id", "a", "b c", "d", *ORDER]
    ordered = [tuple(r)[:4] for r in got.orderBy(*ORDER).collect()]
    want = [one_task(spark, str(tmp_path / f"src/f{k}.csv"), sep) for k in range(3)]
    assert ordered == [r for w in want for r in w]
    splits = {(r["_file"], r["_split"]) for r in got.select("_file", "_split").collect()}
    assert len(splits) > 12


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(["inside"] * 900)
    write_csv_file(str(tmp_path / "a.csv"), ["id", "a"], [("1", "x"), ("2", long), ("3", "y"), ("4", long + '"'), ("5", "")])
    got = read_csv_records(spark, str(tmp_path / "a.csv")).orderBy(*ORDER).collect()
    assert [tuple(r)[:2] for r in got] == one_task(spark, str(tmp_path / "a.csv"), ",")
    with pytest.raises(ValueError, match="not closed"):
        read_csv_records(spark, str(tmp_path / "a.csv"), max_record=1000)


def test_windows_line_ends_header_and_empty_lines(spark, tmp_path, small_splits):
    body = '\ufeffid,a\r\n1,"x\r\ny"\r\n\r\n2,plain\r\n3,"q ""z"""\r\n'
    (tmp_path / "w.csv").write_bytes(body.encode())
    got = read_csv_records(spark, str(tmp_path / "w.csv")).orderBy(*ORDER).collect()
    assert [tuple(r)[:2] for r in got] == one_task(spark, str(tmp_path / "w.csv"), ",") == [("1", "x\ny"), ("2", "plain"), ("3", 'q "z"')]
    (tmp_path / "n.csv").write_bytes(b'"i\nd",a\n1,"x\r\ny"\n\n2,"p\rq"\n3,"\r"\n')
    got = read_csv_records(spark, str(tmp_path / "n.csv")).orderBy(*ORDER).collect()
    assert [tuple(r)[:2] for r in got] == one_task(spark, str(tmp_path / "n.csv"), ",")


def test_headers_must_agree_and_records_be_whole(spark, tmp_path, small_splits):
    write_csv_file(str(tmp_path / "s/a.csv"), ["id", "a"], [("1", "x")])
    write_csv_file(str(tmp_path / "s/b.csv"), ["a", "id"], [("x", "1")])
    with pytest.raises(ValueError, match="header"):
        read_csv_records(spark, str(tmp_path / "s"))
    write_csv_file(str(tmp_path / "t/a.csv"), ["id", "a"], [("1", "x"), ("2", "y", "z"), ("3", "w\nw")])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_records(spark, str(tmp_path / "t")).collect()
    kept = read_csv_records(spark, str(tmp_path / "t"), mode="PERMISSIVE", corrupt="_bad").orderBy(*ORDER).collect()
    assert [r["id"] for r in kept if r["_bad"] is None] == ["1", "3"] and [r["_bad"] for r in kept if r["_bad"]] == ["2,y,z"]


def test_no_records(spark, tmp_path):
    write_csv_file(str(tmp_path / "e.csv"), ["id", "a"], [])
    assert read_csv_records(spark, str(tmp_path / "e.csv")).collect() == []


def test_end_states_follow_the_parser(spark):
    def scan(line, inside):
        """A plain state machine of the dialect."""
        at, begin = 0, not inside
        while at < len(line) or begin is None:
            if not inside:
                if begin and at < len(line) and line[at] == '"':
                    inside, at = True, at + 1
                    continue
                cut = line.find(",", at)
                if cut < 0:
                    return 0
                at, begin = cut + 1, True
                if at == len(line):
                    return 0
            else:
                cut = line.find('"', at)
                if cut < 0:
                    return 1
                if line[cut + 1 : cut + 2] == '"':
                    at = cut + 2
                else:
                    at, inside, begin = cut + 1, False, False
        return int(inside)

    rng = random.Random(2)
    lines = ["".join(rng.choices('",ab', k=rng.randint(0, 9))) for _ in range(3000)] + ['a,"' + '""' * 5000, "x," * 3000 + '"']
    outside, inside = _ends_inside(F.col("value"), ",")
    got = spark.createDataFrame([(x,) for x in lines], "value string").select("value", outside.cast("int"), inside.cast("int")).collect()
    assert [(r[1], r[2]) for r in got] == [(scan(r[0], False), scan(r[0], True)) for r in got]


def test_landing_reads_a_file_in_several_tasks(spark, tmp_path, small_splits):
    rows = rows_of(9, 300)
    write_csv_file(str(tmp_path / "big.csv"), ["ID", "a", "b", "c"], rows)
    fast = jobs.land_source(spark, "accidents", str(tmp_path / "big.csv"), str(tmp_path / "fast"), records_per_file=70)
    slow = jobs.land_source(spark, "accidents", str(tmp_path / "big.csv"), str(tmp_path / "slow"), records_per_file=70, one_task=True)
    assert fast == slow == {"rows": 300, "chunks": 5}
    for k in range(5):
        parts = [one_task(spark, str(tmp_path / f"{kind}/accident_data/chunk={k}"), ",") for kind in ("fast", "slow")]
        assert parts[0] == parts[1] and len(parts[0]) == min(70, 300 - 70 * k)


def test_records_of_one_file_stay_in_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f'{i},"x\n{i}"\n' for i in range(2000)))
    conf = {
        "spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = read_csv_records(spark, str(tmp_path / "a.csv")).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["count"] for r in rows) == 2000 and len(rows) > 2


def test_source_files_follow_the_texts(spark, monkeypatch):
    from crashlake import suite

    docs = spark.createDataFrame([("abc",), (None,), ("defgh",)], "text string")
    assert suite._source_files(docs) == 2 and suite._source_files(docs.limit(0)) == 2
    monkeypatch.setattr(suite, "SOURCE_FILE_CHARS", 2)
    assert suite._source_files(docs) == 4


@pytest.mark.parametrize("own", [False, True])
def test_a_landing_leaves_no_lines_no_staged_rows_and_no_shuffle_files(spark, tmp_path, small_splits, own):
    from pathlib import Path

    from crashlake.config import shared_dir

    def left():
        top = Path(shared_dir(spark).removeprefix("file:"))
        local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].toString())
        return {p for n in ("lines", "staged") for p in top.glob(f"crashlake/*/{n}")} | set(local.rglob("shuffle_*.data"))

    rows = [(str(i), "two\nlines", "x") for i in range(200)]
    for k in range(2):
        write_csv_file(str(tmp_path / f"src/f{k}.csv"), ["id", "a", "b"], rows[100 * k : 100 * k + 100])
    before = left()
    out = jobs.land_source(spark, "accidents", str(tmp_path / "src"), str(tmp_path / "raw"), records_per_file=30, own_source=own)
    assert out == {"rows": 200, "chunks": 7}
    # the last small execution may still be cleaning up
    assert [p for p in left() - before if p.name in ("lines", "staged") or p.stat().st_size > 2000] == []
    assert (tmp_path / "src").exists() != own
    assert read_csv(spark, str(tmp_path / "raw")).count() == 200
