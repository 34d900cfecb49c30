"""Session settings and the shared folder that survives the loss of an executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import is_remote


def local_session(app: str, cores: str | int = "*", partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.minPartitionNum", str(partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session setting for a while."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where driver and
    executors are one process; elsewhere a missing setting is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or context.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach.")
        root = tempfile.mkdtemp(prefix="assaymill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name below the shared root."""
    return f"{shared_root(spark)}/assaymill/{purpose}-{uuid.uuid4().hex}"


def emptied(spark: SparkSession, folder: str) -> None:
    """Remove what is in a folder and keep the folder, which a stream may start on again.

    Through the file system of the folder, which a plain session can reach; over Connect all stays.
    """
    if is_remote():
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in store.listStatus(path):
        store.delete(found.getPath(), True)


# Spark's own setting, for executions of a plain session.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Let each execution's shuffle files go when it ends, not when the driver next collects its garbage.

    For steps that write or checkpoint what they make: a DataFrame that is executed again makes its shuffles again.
    """
    if is_remote():
        yield
        return
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a checkpoint in the shared folder.

    Over Connect the server has that folder and this side cannot ask for it.
    """
    if not is_remote():
        shared_root(df.sparkSession)
    return df.checkpoint()
