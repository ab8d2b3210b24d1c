"""Parquet table writes (K1-K3) with row counts (K5) read from the written files' footers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    dynamic: bool = False,
    mode: str = "overwrite",
    cluster_by: list[str] | None = None,
) -> int:
    """Overwrite ``path`` with ``df`` as Parquet and return the number of rows written.

    Partitioned writes go through a ``REBALANCE`` on the partition columns: rows
    of one partition value meet in one task (few files per folder), while AQE
    splits a value that holds a large share of the rows into several tasks of
    the advisory size instead of one huge task. ``dynamic`` replaces only the
    partitions present in ``df`` (incremental loads); otherwise the whole table
    is replaced; ``mode="append"`` adds files. ``cluster_by`` sorts each task's
    rows by the partition columns and then these columns - the sort the
    partitioned writer needs anyway, extended - so every file holds narrow
    ranges of them: better compression and row-group statistics that let a
    filter on them skip data. The count is read from the footers of the written
    files; an append or a dynamic overwrite, whose folder holds other rows too,
    returns 0.
    """
    writer_df = df.hint("rebalance", *partition_by) if partition_by else df
    if cluster_by:
        writer_df = writer_df.sortWithinPartitions(*(partition_by or []), *cluster_by)
    writer = writer_df.write.mode(mode).option(
        "partitionOverwriteMode", "dynamic" if dynamic else "static"
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if mode == "append" or dynamic:
        return 0
    return df.sparkSession.read.schema(df.schema).parquet(path).count()
