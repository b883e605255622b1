"""Session helpers: a local session for tests and the bench, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "candlelake", conf: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CANDLELAKE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset (local tests) is a folder chosen here; on a
    cluster an unset value is an error, since a machine-local folder is not shared.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (e.g. on HDFS or object storage)")
    path = tempfile.mkdtemp(prefix="candlelake-")
    spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the work folder (one per run, never reused)."""
    return f"{work_dir(spark)}/candlelake/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when the write ends, not when the driver happens to collect its garbage."""
    was = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_CONF) if was is None else spark.conf.set(CLEANUP_CONF, was)
