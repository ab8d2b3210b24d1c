"""Session settings and shared scratch space.

Library code never builds a session for a caller; :func:`local_session` exists
for tests, the bench and the command-line jobs only.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE re-plans joins and splits skewed shuffle
# partitions at run time; the rebalance settings let partitioned writes split a
# hot (year, month) into several files instead of one huge task.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints (dense keys) are deleted once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "crashlake", extra: dict[str, str] | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and scratch tables.

    It is the cluster's ``spark.checkpoint.dir``. Only in a local session that has
    none (tests) is a fresh local folder made and registered; on a cluster a
    driver-local folder would not be visible to executors, so that raises.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="crashlake-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder."""
    return "/".join([shared_dir(spark), "crashlake", uuid.uuid4().hex[:12], *parts])


def staging_path(spark: SparkSession, owner: str, name: str) -> str:
    """A fixed scratch path per ``owner`` (e.g. a lake root) under the shared folder.

    Staging tables written there are overwritten by the next run for the same
    owner, so they do not accumulate.
    """
    key = hashlib.sha1(owner.encode()).hexdigest()[:16]
    return "/".join([shared_dir(spark), "crashlake", "staging", key, name])


#: Spark removes an execution's shuffle files when it has ended, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the executions inside go as soon as each has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def join_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *[p.strip("/") for p in parts]])


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
