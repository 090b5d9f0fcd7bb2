"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
#: removes a query's shuffle files when it ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job relies on; cluster sizes stay with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="chartweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the driver and all executors share.

    Only a local session, whose executors are the driver itself, may go without one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_folder()


def scratch_folder(spark: SparkSession) -> str:
    """A new name below the shared folder; what is written there goes when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/chartweave-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    files.deleteOnExit(path)
    return path.toString()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries begun inside go when the query ends; otherwise they stay until the driver collects
    garbage, and jobs that write one table after another hold the shuffles of all of them.

    A frame that is executed again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
