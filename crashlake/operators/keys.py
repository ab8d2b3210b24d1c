"""Dense, deterministic row positions and surrogate keys (P5, K6).

``dense_index`` gives every row its zero-based position in a total order
without moving the data into one task:

1. range-partition on the order and sort inside each partition;
2. tag rows with ``monotonically_increasing_id`` = (partition << 33) + position;
3. checkpoint that frame to the shared checkpoint folder, so every later pass
   sees the very same ids even if executors are lost and tasks re-run;
4. count rows per partition (one row per partition) and turn the counts into
   running offsets - the only unpartitioned window, over at most
   ``num_partitions`` rows;
5. join the offsets back and add them to the in-partition position.

It serves dimension keys, whose rows are few and narrow. ``staged_positions``
does the same for whole datasets that are landed in chunks: rows are written
once, as Parquet, with their run and place in it, and numbered from those files,
so no second scan of the source can disagree with the first.

The order must be total (unique) for the result to be a pure function of the
input; dimension keys are unique after dedupe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crashlake.config import scratch_path

_POS_MASK = (1 << 33) - 1


def _asc(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def _cols(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def dense_index(
    df: DataFrame,
    order_by: list[str],
    index_col: str = "_idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``index_col`` (bigint, 0..n-1) = position of the row in ``order_by`` ascending, nulls first.

    Without ``num_partitions`` the number of range partitions is left to AQE:
    it starts from ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``
    (or the shuffle partitions) and merges adjacent ranges up to the advisory
    partition size, so partitions stay contiguous, ordered and right-sized at
    any data volume.
    """
    keys = [_asc(c) for c in order_by]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    tagged = ranged.sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.select(
        *_cols(df),
        F.shiftright("_mid", 33).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit(_POS_MASK)).alias("_pos"),
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return tagged.join(offsets, "_pid").select(
        *_cols(df), (F.col("_off") + F.col("_pos")).cast("bigint").alias(index_col)
    )


def staged_positions(df: DataFrame, order_by: list[str] | None, index_col: str = "_idx") -> tuple[DataFrame, int]:
    """Write ``df`` once as Parquet in the shared folder; return it with each row's position, and the rows written.

    The order is ``order_by``, or, when it is ``None``, the source order of a
    file scan: file path, then byte position of the split, then record. Rows of
    one split (or one sorted range) are a run; each row is written with its run
    and a running id that was drawn in that same write. Run lengths, read from
    the staged files, become offsets. The frame's ``scratch`` is the folder written, for the caller to delete.
    """
    spark = df.sparkSession
    if order_by is None:
        staged = df.select(
            *_cols(df),
            F.col("_metadata.file_path").alias("_run"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mid"),
        )
    else:
        keys = [_asc(c) for c in order_by]
        staged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
        staged = staged.select(*_cols(df), F.lit("").alias("_run"), F.shiftright("_mid", 33).alias("_block"), "_mid")
    path = scratch_path(spark, "staged")
    staged.write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(staged.schema).parquet(path)
    runs = staged.groupBy("_run", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_run", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per run
    offsets = runs.select("_run", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    runs_path = scratch_path(spark, "runs")  # stored, so that Spark sees a row per run and leaves the staged rows where they are
    offsets.write.parquet(runs_path)
    offsets = spark.read.schema(offsets.schema).parquet(runs_path)
    placed = staged.join(offsets, ["_run", "_block"]).select(
        *_cols(df), (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint").alias(index_col)
    )
    placed.scratch = path
    return placed, staged.count()  # from the footers
