import math
import random

from pyspark.sql import functions as F

from crashlake.llm import topk


def brute(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % 7 == 0}):
        for v in [v for i, v in ok if i == q][:1]:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, rank string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 7 == 0, k).collect())


def test_against_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(19)]) for i in range(300)]
    rows += [(i, [0.5] * 19) for i in range(300, 360)]  # many copies
    rows += [(1001, None), (1002, [None] * 19), (1003, [float("nan")] + [0.0] * 18), (1004, [float("inf")] * 19), (1005, []), (1008, [1.0, 2.0])]
    rows += [(1015, [1.0, 0.5]), (None, [0.1] * 19)]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    import numpy as np

    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    assert run(spark, rows) == brute(rows, 5)


def test_repeated_query_rows_are_ranked_together_as_in_the_sql(spark):
    import duckdb
    import pyarrow as pa

    from crashlake.llm.queries import ORACLE_SQL

    rng = random.Random(8)
    rows = [(i, [rng.randint(-9, 9) / 8 for _ in range(6)]) for i in range(120)]
    rows += [rows[0], rows[50], (50, [0.25] * 6), rows[7], rows[100], rows[100]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    with duckdb.connect() as db:
        db.register("embeddings", pa.table({"vec_id": [i for i, _ in rows], "embedding": pa.array([v for _, v in rows], pa.list_(pa.float32()))}))
        assert got == sorted(db.execute(ORACLE_SQL["op8_topk_search"]).fetchall())


def test_fewer_than_k_and_empty(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 7 == 0).count() == 0


def test_components_of_any_size(spark, monkeypatch):
    most = 2**63 - 1
    held = lambda x: min(max(x, -most - 1), most)
    rng = random.Random(6)
    rows = [(i, [rng.choice([1.0, -1.0]) * rng.uniform(0, 10.0 ** rng.choice([0, 3, 6, 7])) for _ in range(5)]) for i in range(250)]
    rows += [(300, [1e15] * 5), (301, [1e15, -1e15, 1e15, 1.0, 0.0]), (302, [1e300] * 5), (308, [-1e300, 1.0, 0.0, 0.0, 0.0]), (309, [7e6 + 1 / 256] * 5)]
    rows += [(310 + i, [7e6 + i / 256] * 5) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 7 == 0, 5).collect())
    whole = [(i, [held(math.floor(256 * x)) for x in v]) for i, v in rows]
    want = []
    for q, v in whole:
        if q % 7 == 0:
            found = sorted((-held(sum(a * b for a, b in zip(v, w))), i) for i, w in whole if i != q)
            want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(found[:5])]
    assert got == sorted(want)


def test_many_rows_of_one_id_are_dealt_over_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-99, 99) / 100 for _ in range(4)]) for i in range(1, 90)]
    rows += [(5, [rng.randint(-99, 99) / 100 for _ in range(4)]) for _ in range(20_000)]
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 512)
    search = topk.search_block

    def counted(q_ids, q, c_ids, c, k):
        assert len(c_ids) < 2 * 512, "one block took the rows of an id"
        return search(q_ids, q, c_ids, c, k)

    monkeypatch.setattr(topk, "search_block", counted)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 7 == 0, 5).collect())
    assert got == brute(rows, 5)
