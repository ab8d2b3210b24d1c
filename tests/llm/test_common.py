import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crashlake import versions
from crashlake.llm.common import BATCH_BYTES, components, id_and_text, materialise, release


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in parent)


rng = random.Random(11)
GRAPHS = [
    [],
    [(3, 3)],
    [(i + 1, i) for i in range(60)],  # a chain
    [(0, i) for i in range(1, 200)] + [(5, 5)],  # a star
    [(999, i) for i in range(50)] + [(i, -i - 1) for i in range(20)],
    [(rng.randrange(150), rng.randrange(150)) for _ in range(120)],
]


@pytest.mark.parametrize("edges", GRAPHS)
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(tuple(r) for r in components(df).select("node", "root").collect()) == brute(edges)


def test_materialised_tables_are_shared_and_released(spark):
    t = materialise(spark.range(10).withColumn("r", F.rand()), "t")
    assert t.collect() == t.collect() and t.count() == 10
    assert versions.exists(spark, t.scratch)
    release(t)
    assert not versions.exists(spark, t.scratch)


def test_batches_handed_to_python_are_bounded_by_bytes(spark):
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))  # 30 MB in a partition

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    found = id_and_text(docs).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 3000
    assert max(r["size"] for r in found) < 2 * BATCH_BYTES
