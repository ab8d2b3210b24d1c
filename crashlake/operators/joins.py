"""Fact-to-dimension joins (J1-J7).

The strategy is left to Spark: a dimension read from Parquet has a known size,
so a small one is broadcast when the plan is made, and adaptive execution
decides again by measured bytes. Beyond the threshold the join shuffles, and a
hot key - null keys of an outer join included - is split into several tasks by
the skew-join handling (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def dimension_join(fact: DataFrame, dim: DataFrame, on: Column | str | list[str], how: str = "inner") -> DataFrame:
    """Join a (large) fact to a dimension; null keys never match."""
    return fact.join(dim, on=on, how=how)
