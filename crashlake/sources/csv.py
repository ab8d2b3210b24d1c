"""Header CSV scans (S1-S3).

RFC-4180 dialect everywhere: ``""`` escapes a quote and quoted fields may hold
the delimiter or line breaks. Spark's defaults (backslash escape, one record per
line) would silently split such records, so every read and write in the lake
goes through :data:`CSV_DIALECT`. ``multiLine`` makes one file one task, which
is why raw datasets are landed in record-bounded chunks; a source known to hold
no line break inside a record is read with ``multi_line=False`` and splits by bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crashlake import versions
from crashlake.config import join_path
from crashlake.schemas import RAW_DELIMITERS, RAW_FOLDERS

CSV_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Folders are listed by a few tasks a core, not by up to 10,000: a task takes longer than the listing of a chunk's folder.
#: A setting of the session's own stays.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def few_listing_tasks(spark: SparkSession) -> None:
    if LISTING not in spark.conf.getAll:
        spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))


def read_header(spark: SparkSession, path: str, sep: str = ",") -> T.StructType:
    """Columns of one of the files below ``path``, found without listing the others."""
    return read_csv(spark, versions.some_file(spark, path, ".csv") or path, sep=sep).schema


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType | None = None,
    columns: list[str] | None = None,
    mode: str = "FAILFAST",
    recursive: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """Scan header CSV; every column is a string.

    Without ``schema`` the column names come from the header (one small job that
    reads the first line). Either way every file's header is validated against
    the schema (``enforceSchema=false``), so a file whose columns moved fails
    instead of being read positionally. ``columns`` keeps a subset; the CSV parser then
    tokenises only those columns. ``recursive`` reads chunk folders
    (``chunk=K/part-*.csv``) without turning folder names into columns.
    ``FAILFAST`` raises on a malformed record instead of dropping or padding it;
    with ``PERMISSIVE`` and a ``_corrupt_record`` column in ``schema`` malformed
    records are kept aside in that column.
    """
    few_listing_tasks(spark)
    # enforceSchema=false: every file's header is checked against the schema (given or taken from the
    # first header), so a file whose columns moved fails instead of being read by position.
    reader = spark.read.options(**CSV_DIALECT).option("sep", sep).option("mode", mode).option("enforceSchema", "false")
    if not multi_line:
        reader = reader.option("multiLine", "false")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if columns is not None:
        df = df.select(*[df[f"`{c}`"] for c in columns])
    return df


def read_raw_dataset(
    spark: SparkSession,
    raw_root: str,
    dataset: str,
    schema: T.StructType | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Scan one landed raw dataset (``accidents``, ``airports`` or ``cities``) under a raw-zone root."""
    return read_csv(
        spark,
        join_path(raw_root, RAW_FOLDERS[dataset]),
        sep=RAW_DELIMITERS[dataset],
        schema=schema,
        columns=columns,
    )
