"""Helpers shared by the corpus operators: materialised tables, components, digests.

Every table that an operator reads more than once is written as Parquet under the
cluster's shared folder (``spark.checkpoint.dir``) and read back, so a lost
executor costs a task, not a lineage, and later plans see real sizes.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake import versions
from crashlake.config import scratch_path, shuffles_removed


_shipped: set[str] = set()

#: Batches that Spark hands to Python end at so many bytes, not only at 10,000 rows: an executor holds a batch of
#: each running task twice or more, in the JVM (outside its heap) and in Python. A setting of the session's own stays.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, as ``--py-files`` would; their functions import it."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    sc = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if sc.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="crashlake-py-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and return a reader over it; its shuffle files go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read again."""
    for t in tables:
        versions.delete(t.sparkSession, t.scratch)


class Scratch:
    """Tables of one run: all but the result are deleted when the run is over, also when it fails."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame, name: str) -> DataFrame:
        out = materialise(df, name)
        self.tables.append(out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables before the run is over."""
        release(*tables)
        gone = {t.scratch for t in tables}
        self.tables = [t for t in self.tables if t.scratch not in gone]

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """Write what the run returns; it outlives the run."""
        return materialise(df, name)

    def __exit__(self, *exc) -> None:
        release(*self.tables)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names: other columns cannot clash."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def input_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of an undirected graph given as (a long, b long).

    Alternating large-star and small-star passes (Kiveris et al., 2014). Minima are
    taken by partially aggregated groupBys and joined back, so a vertex with a huge
    neighbourhood is never gathered in one task. Every pass is materialised. Returns
    (node, root): root is the smallest node of the component; nodes that only have
    self loops are absent.
    """

    def settled(e: DataFrame) -> bool:
        """Has every node one parent, and no parent a parent of its own?"""
        several = e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        chained = e.select(F.col("b").alias("p")).distinct().join(e, F.col("p") == F.col("a"), "left_semi")
        return several.isEmpty() and chained.isEmpty()

    # a > b throughout: a is the child, b its current parent
    current = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        if settled(current):
            break
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        low = stored = materialise(low, "low")  # apart from the join, so that a node with a huge neighbourhood can be split there
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        last, current = current, materialise(small, "edges")
        release(last, stored)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} passes")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
