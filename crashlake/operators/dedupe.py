"""Deterministic deduplication (A4, A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_smallest(df: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the smallest row by ``order`` then every other column.

    Unlike ``dropDuplicates`` the surviving row is a pure function of the input
    set. ``min(struct(...))`` is aggregated partially before the shuffle, so a
    hot key collapses map-side instead of sending all its rows to one task.
    Null keys form one group, as in ``dropDuplicates``.
    """
    rest = [c for c in df.columns if c not in key]
    order = list(order or [])
    tail = [c for c in rest if c not in order]
    kept = df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in order + tail])).alias("_kept")
    )
    return kept.select(*[F.col(f"`{c}`") if c in key else F.col("_kept").getField(c).alias(c) for c in df.columns])


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct value combinations; null is one value (hash aggregate with a partial phase)."""
    return df.select(*[F.col(f"`{c}`") for c in columns]).distinct()
