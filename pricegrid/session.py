"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None, app: str = "pricegrid", **extra: str
) -> SparkSession:
    """A session with the settings the library is written for.

    ``master`` stays unset on a cluster, where the launcher decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, task_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle settings for an input size.

    Starts with one partition per ``task_bytes`` of input, so that a partition
    fits into a task's share of memory, and lets the adaptive plan merge them.
    """
    parts = max(200, -(-input_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost together with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return os.path.dirname(context.getCheckpointDir())
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="pricegrid-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Removes a query's shuffle files when it ends; the rows are written by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df, path: str) -> None:
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def staged(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    For inputs that several steps read, such as parsed documents: later reads
    touch only the columns they need, and nothing is parsed again when an
    executor is lost.
    """
    path = fresh_path(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged_while(df, name: str):
    """``staged`` for the length of a block; its folder is deleted at the end."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    try:
        _write(df, path)
        yield spark.read.parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, wherever the session keeps its files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def checkpointed(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
