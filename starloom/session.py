"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every star build relies on. UTC keeps timestamp arithmetic free of
# daylight-saving jumps; AQE re-plans joins from runtime sizes (broadcast only
# when the measured side is under the threshold, skew splitting otherwise).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables bucketed on the order alone also serve joins on (order, line).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above. The master and the
    number of shuffle partitions are the cluster's unless the caller names them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def join_by_order(spark: SparkSession) -> None:
    """Settings that a session of somebody else's may lack: rows that lie by order are not
    dealt out again for a join on (order, line), nor for a union of such rows. A side of a
    join of up to 32 MB is sent whole. Rows are larger than the files that hold them, keys
    by far (9 M take a few MB of a file, and hundreds as a table to look them up in), so a
    size that is told from files counts 16 times; a size measured in the run is exact."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "16.0")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile are removed when its write ends: nothing
    reads them again, and otherwise they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def ensure_utc(spark: SparkSession) -> None:
    """Timestamp parsing and interval maths assume a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession, fallback_parent: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is. When it is unset,
    a local session (tests) gets a fresh folder under ``fallback_parent`` (or the
    system temp dir), registered with the SparkContext; on a cluster, whose
    machines do not share such a folder, that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not (fallback_parent or spark.sparkContext.master.startswith("local[")
            or spark.sparkContext.master == "local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    parent = fallback_parent or tempfile.gettempdir()
    os.makedirs(parent, exist_ok=True)
    path = tempfile.mkdtemp(prefix="starloom-ckpt-", dir=parent)
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
