"""Lake versions: a build never touches the tables that readers see.

Every build writes into a folder of its own, ``<lake>/version-<n>/<table>``, and
creates the empty file ``_DONE`` there when all its tables are written. A table is
read from the newest version that is done and has it, so a build that fails leaves
the lake as it was; its folder is ignored. One writer at a time is assumed.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from crashlake.config import join_path

DONE = "_DONE"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, as Spark names the files below it."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toUri().toString()


def some_file(spark: SparkSession, path: str, ending: str) -> str | None:
    """A file below the path that readers see: neither it nor a folder above it is hidden."""
    top, files = _path(spark, path), _fs(spark, path).listFiles(_path(spark, path), True)
    while files.hasNext():
        found = at = files.next().getPath()
        names = []
        while at.depth() > top.depth():
            names.append(at.getName())
            at = at.getParent()
        if names and names[0].endswith(ending) and not any(n.startswith(("_", ".")) for n in names):
            return found.toString()
    return None


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def _numbers(spark: SparkSession, lake_root: str) -> list[int]:
    if not exists(spark, lake_root):
        return []
    names = [s.getPath().getName() for s in _fs(spark, lake_root).listStatus(_path(spark, lake_root))]
    return sorted((int(m[1]) for n in names if (m := re.fullmatch(r"version-(\d+)", n))), reverse=True)


def version_path(lake_root: str, number: int) -> str:
    return join_path(lake_root, f"version-{number}")


def new_version(spark: SparkSession, lake_root: str) -> str:
    """Folder of the next version; not seen by readers until ``complete``."""
    return version_path(lake_root, max(_numbers(spark, lake_root), default=0) + 1)


def complete(spark: SparkSession, version: str) -> None:
    _fs(spark, version).create(_path(spark, join_path(version, DONE)), True).close()


def table_path(spark: SparkSession, lake_root: str, table: str) -> str:
    """Where the table is read; without versions, directly under the root."""
    for n in _numbers(spark, lake_root):
        version = version_path(lake_root, n)
        if exists(spark, join_path(version, DONE)) and exists(spark, join_path(version, table)):
            return join_path(version, table)
    return join_path(lake_root, table)


def drop_old_versions(spark: SparkSession, lake_root: str, tables: list[str], keep: int = 2) -> list[str]:
    """Delete versions older than the newest ``keep``, unless a table is still read from them."""
    used = {table_path(spark, lake_root, t).rsplit("/", 1)[0] for t in tables}
    old = [version_path(lake_root, n) for n in _numbers(spark, lake_root)[keep:]]
    gone = [v for v in old if v not in used]
    for v in gone:
        delete(spark, v)
    return gone
