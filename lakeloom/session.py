"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    Partition counts and sizes stay cluster settings: pass them as keyword arguments with
    ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="4000"``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # Checkpoint files go when the frame is no longer used.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # State of streaming jobs on local disk instead of the heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # No call-site capture per column expression: plans are built several times faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session on one machine may go without the setting: then a temporary folder is made, once per
    session. On a cluster that folder would be a different disk for every executor, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if base is None:
        base = context.getCheckpointDir()
    if base is None:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lakeloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table or stream checkpoint of one run."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def removed(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any store that Spark reads; False if it was not there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold within the block, then those from before. They hold for all threads of the session."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
