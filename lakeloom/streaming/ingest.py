"""Raw capture: message stream to an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.messages import decode_json


def file_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of text lines from the files of a folder; the number of files sets the pace."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def kafka_lines(
    spark: SparkSession, servers: str, topic: str, group: str | None = None, start: str = "earliest"
) -> DataFrame:
    """Stream of message values. Needs the Kafka connector on the class path (not run in tests)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def with_watermark(df: DataFrame, ts: str, lateness: str = "5 minutes") -> DataFrame:
    """Event-time watermark; times without a zone are read as UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def with_ingest_time(df: DataFrame, out: str = "ingest_ts") -> DataFrame:
    """Third clock beside event and write time: when this job took the row in.

    One value per micro-batch in a stream.
    """
    return df.withColumn(out, F.current_timestamp())


def decode_events(lines: DataFrame, schema: StructType, ts: str, lateness: str = "5 minutes") -> tuple[DataFrame, DataFrame]:
    """Decoded events with watermark and ingest time, and the unreadable lines.

    No stateful operator follows, so the watermark drops nothing: late rows and copies stay.
    """
    good, bad = decode_json(lines, "value", schema)
    return with_ingest_time(with_watermark(good, ts, lateness)), with_ingest_time(bad)


def append_to_table(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Start an append to Parquet, exactly once per checkpoint.

    ``every`` is the trigger interval of a long-running job (``10 seconds``). Without it the job
    takes what is there and ends. Same checkpoint: resume; new checkpoint and new path: restart
    from the earliest message. ``name`` is what listeners see.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start(path)


def ingest_events(
    lines: DataFrame,
    schema: StructType,
    ts: str,
    path: str,
    checkpoint: str,
    lateness: str = "5 minutes",
    every: str | None = None,
    quarantine: str | None = None,
) -> list[StreamingQuery]:
    """Raw capture of a message stream; unreadable lines go to ``quarantine`` if given.

    Good and bad lines come from one query, so the source is read once and one consumer group is
    enough. Both outputs then have one folder per micro-batch (``epoch=...``), which a repeated
    micro-batch replaces.
    """
    if not quarantine:
        good, _ = decode_events(lines, schema, ts, lateness)
        return [append_to_table(good, path, f"{checkpoint}/good", every)]

    def split(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # read by both writes
        good, bad = decode_events(batch, schema, ts, lateness)
        good.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/epoch={epoch}")
        batch.unpersist()

    writer = lines.writeStream.option("checkpointLocation", f"{checkpoint}/both").foreachBatch(split)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return [writer.start()]
