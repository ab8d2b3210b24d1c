"""Data-quality checks (Q1-Q11) as DataFrames.

Checks that read the same table are computed in one aggregate (one scan) and
unpivoted with ``inline``; the report is a union of such rows,
``(check_name, table_name, observed, passed)``. Only the job raises.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    observed: Column  # aggregate expression, evaluated once over the table
    rule: str  # "positive" (observed > 0), "zero" (observed == 0) or "report" (always passes)


def non_empty_check() -> Check:
    return Check("non_empty", F.count(F.lit(1)), "positive")


def range_check(column: str, lo: int, hi: int, name: str | None = None) -> Check:
    """Values outside ``[lo, hi]``; null is not a violation (SQL ``NOT BETWEEN``)."""
    bad = ~F.col(column).between(lo, hi)
    return Check(name or f"{column}_range", F.count(F.when(bad, 1)), "zero")


def length_check(column: str, length: int, name: str | None = None) -> Check:
    """Values whose length differs from ``length``; null is not a violation."""
    return Check(name or f"{column}_length", F.count(F.when(F.length(column) != length, 1)), "zero")


def pattern_check(column: str, regex: str, name: str | None = None) -> Check:
    return Check(name or f"{column}_pattern", F.count(F.when(~F.col(column).rlike(regex), 1)), "zero")


def cast_check(raw: str, parsed: Column, name: str | None = None) -> Check:
    """Raw values that are there but do not parse (P6); reported, not failed."""
    bad = F.col(f"`{raw}`").isNotNull() & parsed.isNull()
    return Check(name or f"cast_{raw}", F.count(F.when(bad, 1)), "report")


def null_check(column: str, name: str | None = None, rule: str = "zero") -> Check:
    return Check(name or f"{column}_nulls", F.count(F.when(F.col(column).isNull(), 1)), rule)


def table_checks(df: DataFrame, table_name: str, checks: list[Check]) -> DataFrame:
    """Evaluate all ``checks`` on ``df`` in one pass."""
    row = df.agg(*[c.observed.cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)])
    items = []
    for i, c in enumerate(checks):
        obs = F.col(f"c{i}")
        passed = {"positive": obs > 0, "zero": obs == 0, "report": F.lit(True)}[c.rule]
        items.append(F.struct(F.lit(c.name).alias("check_name"), obs.alias("observed"), passed.alias("passed")))
    return row.select(F.inline(F.array(*items))).select(
        "check_name", F.lit(table_name).alias("table_name"), "observed", "passed"
    )


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table and whether it is positive (Q1-Q3 plus weather)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("observed")).select(
            F.lit(name).alias("table_name"), "observed", (F.col("observed") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    return _union(parts)


def null_profile(df: DataFrame, missing: dict[str, Column]) -> DataFrame:
    """Missing values per column in one pass (Q6). ``missing`` maps a name to a
    column that is null when the value is missing (e.g. a failed parse)."""
    row = df.agg(*[F.count(F.when(c.isNull(), 1)).cast("bigint").alias(f"m{i}") for i, c in enumerate(missing.values())])
    items = [F.struct(F.lit(name).alias("column_name"), F.col(f"m{i}").alias("nulls")) for i, name in enumerate(missing)]
    return row.select(F.inline(F.array(*items)))


def duplicate_profile(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys that occur more than once and how many distinct ``value`` they carry (Q7)."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(value).alias("variants"))
        .filter(F.col("n") > 1)
    )


def pk_unique(df: DataFrame, table_name: str, key: list[str]) -> DataFrame:
    """Rows vs distinct keys (Q8). Exact: group by the key (partial aggregation
    first, so a repeated hot key collapses map-side), then a global sum."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n"), F.count(F.lit(1)).alias("keys")
    ).select(F.lit(table_name).alias("table_name"), "n", "keys", (F.col("n") == F.col("keys")).alias("passed"))


def key_check(df: DataFrame, table_name: str, key: list[str], check_name: str = "pk_unique") -> DataFrame:
    """``pk_unique`` as a report row: observed = rows minus distinct keys."""
    return pk_unique(df, table_name, key).select(
        F.lit(check_name).alias("check_name"), "table_name", (F.col("n") - F.col("keys")).alias("observed"), "passed"
    )


def with_reference_hits(fact: DataFrame, refs: list[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Left-join the distinct keys of every referenced dimension, adding ``_hit_<name>``.

    ``refs`` = ``[(name, fact_column, dimension, dimension_key), ...]``. The fact
    is read once for all references.
    """
    joined = fact
    for name, fk, dim, pk in refs:
        keys = dim.select(F.col(pk).alias(f"_k_{name}")).distinct().withColumn(f"_hit_{name}", F.lit(True))
        joined = joined.join(keys, F.col(fk) == F.col(f"_k_{name}"), "left")
    return joined


def orphan_check(name: str, fk: str, rule: str = "zero") -> Check:
    """Non-null foreign keys without a dimension row; evaluated on ``with_reference_hits`` output."""
    return Check(f"fk_{name}", F.count(F.when(F.col(fk).isNotNull() & F.col(f"_hit_{name}").isNull(), 1)), rule)


def fk_orphans(fact: DataFrame, refs: list[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Facts whose non-null foreign key is missing from its dimension (Q9, J7).

    Each key is counted per value first, so a hot value is one row when it meets its dimension.
    """
    parts = []
    for name, fk, dim, pk in refs:
        used = fact.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
        known = dim.select(F.col(pk).alias("_known")).distinct()
        lost = used.join(known, F.col(fk) == F.col("_known"), "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphans")).select(F.lit(name).alias("fk"), "orphans"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(parts: list[DataFrame]) -> DataFrame:
    return _union(parts)


def load_report(raw_rows: int, accidents: DataFrame, cities: DataFrame, airports: DataFrame) -> DataFrame:
    """Row counts of the load (K5): raw facts, joined facts, facts dropped for an unknown
    city, cities and airports. ``raw_rows`` was counted when the raw zone was parsed;
    the tables' counts come from Parquet footers."""
    n = F.count(F.lit(1)).alias("n")
    joined = accidents.agg(n)
    raw = F.lit(raw_rows).cast("bigint")
    fact = joined.select(F.inline(F.array(
        F.struct(F.lit("raw_accidents").alias("stage"), raw.alias("n")),
        F.struct(F.lit("joined").alias("stage"), F.col("n")),
        F.struct(F.lit("dropped_no_city").alias("stage"), (raw - F.col("n")).alias("n")),
    )))
    dims = [df.agg(n).select(F.lit(name).alias("stage"), "n") for name, df in (("cities", cities), ("airports", airports))]
    return _union([fact, *dims])
