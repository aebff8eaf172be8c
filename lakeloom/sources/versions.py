"""Versioned tables on plain Parquet: batches plus a commit log.

Layout: ``<path>/data/batch_id=N`` and ``<path>/log``. A batch is visible once its log row is
written, so a failed write is never seen. ``kind`` is ``replace`` or ``append``. As batch ids
grow with commit order, the batches of a version are one id range, which prunes partitions.
One writer per table is assumed.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "batch_id BIGINT, committed_ts TIMESTAMP_NTZ, kind STRING, epoch BIGINT"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Commit log: one row per commit."""
    try:
        return spark.read.schema(LOG).parquet(f"{path}/log")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LOG)


def commit(df: DataFrame, path: str, kind: str, ts: str, epoch: int | None = None) -> int:
    """Write a batch and log it; returns the batch id.

    An ``epoch`` (micro-batch number) that is already in the log is skipped, so a repeated
    micro-batch is written once.
    """
    if kind not in ("replace", "append"):
        raise ValueError(f"kind must be replace or append, not {kind!r}")
    if not re.fullmatch(r"\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d(\.\d+)?)?", ts):
        raise ValueError(f"ts must be a timestamp, not {ts!r}")
    spark = df.sparkSession
    at = F.lit(ts).cast("timestamp_ntz")
    state = (
        read_log(spark, path)
        .agg(
            F.coalesce(F.max("batch_id"), F.lit(0)).alias("last"),
            F.max(F.when(F.col("epoch") == F.lit(epoch), F.col("batch_id"))).alias("done"),
            (F.max("committed_ts") > at).alias("backwards"),
        )
        .first()
    )
    if state["done"] is not None:
        return state["done"]
    if state["backwards"]:
        raise ValueError("commit time lies before the last commit")
    batch = state["last"] + 1
    df.write.mode("overwrite").parquet(f"{path}/data/batch_id={batch}")
    row = spark.range(1).select(
        F.lit(batch).cast("bigint").alias("batch_id"),
        at.alias("committed_ts"),
        F.lit(kind).alias("kind"),
        F.lit(epoch).cast("bigint").alias("epoch"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return batch


def visible_batches(spark: SparkSession, path: str, ts: str | None = None) -> tuple[int, int]:
    """First and last batch of the version at ``ts`` (now if not given)."""
    log = read_log(spark, path)
    if ts is not None:
        log = log.filter(F.col("committed_ts") <= F.lit(ts).cast("timestamp_ntz"))
    span = log.agg(
        F.max(F.when(F.col("kind") == "replace", F.col("batch_id"))).alias("first"),
        F.max("batch_id").alias("last"),
        F.min("batch_id").alias("oldest"),
    ).first()
    if span["last"] is None:
        raise ValueError(f"no version of {path} at {ts}")
    return (span["first"] if span["first"] is not None else span["oldest"]), span["last"]


def read_batches(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Rows of the batches ``first`` to ``last``; other partitions are not opened.

    Files written before a column existed give NULL for it.
    """
    table = spark.read.option("mergeSchema", "true").option("basePath", f"{path}/data")
    return table.parquet(f"{path}/data").filter(F.col("batch_id").between(first, last)).drop("batch_id")


def read_as_of(spark: SparkSession, path: str, ts: str | None = None) -> DataFrame:
    """The table as it was at ``ts``."""
    return read_batches(spark, path, *visible_batches(spark, path, ts))


def rollback(spark: SparkSession, path: str, to_ts: str, ts: str) -> int:
    """Make the version at ``to_ts`` current again, as a new replace commit."""
    return commit(read_as_of(spark, path, to_ts), path, "replace", ts)


def compact(spark: SparkSession, path: str, ts: str, files: int | None = None) -> int:
    """Rewrite the current version as one batch with few files."""
    df = read_as_of(spark, path)
    df = df.repartition(files) if files else df.repartition()
    return commit(df, path, "replace", ts)


def expired_batches(spark: SparkSession, path: str, before: str) -> DataFrame:
    """Logged batches that no version at or after ``before`` can see."""
    first, _ = visible_batches(spark, path, before)
    return read_log(spark, path).filter(F.col("batch_id") < first)


def expire(spark: SparkSession, path: str, before: str) -> int:
    """Delete the data of expired batches and return how many; their versions can no longer be read."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for row in expired_batches(spark, path, before).select("batch_id").toLocalIterator():
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base, f"batch_id={row['batch_id']}")
        removed += bool(fs.delete(folder, True))
    return removed
