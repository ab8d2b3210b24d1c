"""Lasting surrogate keys (P5, H3): a natural key keeps the id that it got first.

The register is an append-only Parquet table (key columns, id). Keys it does not hold
yet are numbered densely after its largest id, in key order, so a first run gives the
same ids as ``dense_index``. A key that leaves the source keeps its id, and gets it back
when it returns. An append of which a part is visible after a crash does no harm: the
keys that it lacks are numbered after the largest id that is seen. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlake import versions
from crashlake.config import scratch_path
from crashlake.operators.keys import dense_index
from crashlake.sinks import write_table


def _same(a: DataFrame, b: DataFrame, key: list[str]) -> Column:
    """Equal keys, nulls included; a hash join key for Spark."""
    on = F.lit(True)
    for c in key:
        on &= a[c].eqNullSafe(b[c])
    return on


def lasting_ids(df: DataFrame, key: list[str], register: str, id_col: str) -> DataFrame:
    """Add ``id_col``, the lasting id of the row's ``key``; ``df`` holds each key once, null being a key like others.

    New keys are written to the register before this returns, so ids are never given twice, also when the
    caller fails afterwards.
    """
    spark = df.sparkSession
    schema = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in key), T.StructField(id_col, T.LongType())])
    path = scratch_path(spark, "keyed")
    write_table(df, path)  # read twice below, and must be the same both times
    rows = spark.read.schema(df.schema).parquet(path)

    def known() -> DataFrame:
        return spark.read.schema(schema).parquet(register) if versions.exists(spark, register) else spark.createDataFrame([], schema)

    old = known()
    new = rows.select(*key).join(old, _same(rows, old, key), "left_anti")
    top = old.agg(F.max(id_col)).head()[0]
    numbered = dense_index(new, key, "_i").select(*key, (F.col("_i") + F.lit(0 if top is None else top + 1)).cast("long").alias(id_col))
    staged = scratch_path(spark, "new_keys")  # read and appended to the same table: written apart first
    if write_table(numbered, staged):
        write_table(spark.read.schema(schema).parquet(staged), register, mode="append")
    ids = known()
    return rows.join(ids, _same(rows, ids, key)).select(ids[id_col], *(rows[c] for c in df.columns))
