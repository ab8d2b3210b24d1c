"""Parquet lake tables (S4-S7) and file inventories (K9, Q5)."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake import versions
from crashlake.schemas import LAKE_TABLES
from crashlake.sources.csv import few_listing_tasks


def read_table(spark: SparkSession, lake_root: str, table: str) -> DataFrame:
    """Scan a curated table of the lake's current version.

    Reading the table root (not a ``key=*/*.parquet`` file glob) keeps the
    partition columns and lets filters on them prune folders. The curated schema
    is given explicitly, so partition columns keep their declared types and no
    inference job runs.
    """
    path = versions.table_path(spark, lake_root, table)
    if table in LAKE_TABLES:
        schema, _ = LAKE_TABLES[table]
        return spark.read.schema(schema).parquet(path)
    return spark.read.parquet(path)


def register_lake_views(spark: SparkSession, lake_root: str, prefix: str = "") -> dict[str, str]:
    """Expose the four lake tables as temp views for SQL users (S7)."""
    names = {}
    for table in LAKE_TABLES:
        name = f"{prefix}{table}"
        read_table(spark, lake_root, table).createOrReplaceTempView(name)
        names[table] = name
    return names


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row per file under ``root``: path, size and key.

    Only the ``path`` and ``length`` columns are selected, so the binary-file
    source never reads file contents. The key is the path below ``root``, so in
    the raw zone it begins with the dataset's folder (K9).
    """
    few_listing_tasks(spark)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )
    base = urlsplit(root).path.rstrip("/") + "/"
    return files.withColumn("key", F.substring_index("path", base, -1))


def register_lake_tables(spark: SparkSession, lake_root: str, database: str, location: str | None = None) -> dict[str, str]:
    """Register the lake as external tables ``<database>.<table>`` in the session catalog (S7).

    SQL written against a catalog (``SELECT ... FROM db.accidents``) then runs
    unchanged on Spark. Schemas are declared, so nothing is inferred; the
    partitions of partitioned tables are recovered from the folders (a
    distributed listing) and predicates on them prune folders. Calling it
    again after a load or a build points the tables at the current version
    and picks up new partitions; the data stays. ``location`` is where the
    database itself lives (default: the shared scratch folder); the tables
    stay where the lake is.
    """
    from crashlake.config import scratch_path

    db_location = location or scratch_path(spark, f"{database}.db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{db_location}'")
    names = {}
    for table, (schema, parts) in LAKE_TABLES.items():
        name = f"`{database}`.`{table}`"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partitioned = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: only the entry goes
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet{partitioned} "
            f"LOCATION '{versions.table_path(spark, lake_root, table)}'"
        )
        if parts:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.sql(f"REFRESH TABLE {name}")
        names[table] = f"{database}.{table}"
    return names
