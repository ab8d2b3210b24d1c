"""Scalar parsing functions (X1-X5, P6), all JVM-side built-ins.

Spark 4 runs with ANSI mode on, where ``to_date('x')`` raises. Raw text is
therefore parsed with ``try_cast``: a malformed value becomes null, as it did on
the non-ANSI Spark the source pipeline targeted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def safe_date(c: str | Column) -> Column:
    """Leading ``yyyy-MM-dd`` of a timestamp text as a date; null when unparseable."""
    return _col(c).try_cast("date")


def safe_timestamp(c: str | Column) -> Column:
    return _col(c).try_cast("timestamp_ntz")


def safe_int(c: str | Column) -> Column:
    return _col(c).try_cast("int")


def safe_bigint(c: str | Column) -> Column:
    return _col(c).try_cast("bigint")


def safe_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def state_code(iso_region: str | Column) -> Column:
    """``US-OH`` -> ``OH``: drop the first three characters; null stays null."""
    return F.substr(_col(iso_region), F.lit(4))
