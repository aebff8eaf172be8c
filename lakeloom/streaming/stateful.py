"""Windows, joins and dedup over event streams, with state bounded by watermarks.

Every function takes a batch or a streaming frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .ingest import with_watermark


def tumbling(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    aggs: Sequence[Column],
    lateness: str = "5 minutes",
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per event-time window (sliding with ``slide``) and key."""
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = with_watermark(df, ts, lateness).groupBy(span.alias("w"), *keys).agg(*aggs)
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *[c for c in grouped.columns if c != "w"],
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    low: str,
    high: str,
    lateness: str = "5 minutes",
    how: str = "inner",
    bucket: int | None = None,
) -> DataFrame:
    """Pairs of one key with ``left_ts + low <= right_ts <= left_ts + high``.

    With ``bucket`` (seconds, inner joins only) rows are also matched by time bucket, a left row
    once for each bucket its interval touches: a key with very many rows then spreads over time.
    Both sides keep only the rows that can still match. ``left_outer`` emits a left row without
    partner once the watermark has passed its interval.
    """
    names = {c: f"_r_{c}" for c in on}
    r = with_watermark(right, right_ts, lateness).withColumnsRenamed(names)
    a = with_watermark(left, left_ts, lateness)
    cond = F.col(right_ts).between(
        F.col(left_ts) + F.expr(f"INTERVAL {low}"), F.col(left_ts) + F.expr(f"INTERVAL {high}")
    )
    for c, renamed in names.items():
        cond = cond & (F.col(c) == F.col(renamed))
    if not bucket:
        return a.join(r, cond, how).drop(*names.values())
    if how != "inner":
        raise ValueError("time buckets are for inner joins; unmatched_stream has the rows without partner")

    lo, hi = (_slot(F.col(left_ts) + F.expr(f"INTERVAL {x}"), bucket) for x in (low, high))
    a = a.withColumn("_slot", F.explode(F.sequence(lo, hi)))
    r = r.withColumn("_r_slot", _slot(F.col(right_ts), bucket))
    return a.join(r, cond & (F.col("_slot") == F.col("_r_slot")), how).drop(*names.values(), "_slot", "_r_slot")


def unmatched_stream(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    low: str,
    high: str,
    lateness: str = "5 minutes",
    bucket: int = 600,
) -> DataFrame:
    """Rows of ``left`` without a partner at ``left_ts + low`` to ``left_ts + high``, each once.

    Both sides are joined by key and time bucket, so a key with very many rows spreads over time. A left
    row is in every bucket that its interval touches and may miss in one and match in another; so the outer
    join's rows are folded to one match flag per left row, which is emitted when the watermark is past the
    row's time. Left rows that are exact copies of each other come out as one.
    """
    names = {c: f"_r_{c}" for c in on}
    cols = left.columns
    a = with_watermark(left, left_ts, lateness)
    r = with_watermark(right.select(*on, right_ts), right_ts, lateness)
    r = r.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(right_ts).alias("_r_ts"), _slot(F.col(right_ts), bucket).alias("_r_slot"))
    lo, hi = (F.col(left_ts) + F.expr(f"INTERVAL {x}") for x in (low, high))
    a = a.withColumn("_slot", F.explode(F.sequence(_slot(lo, bucket), _slot(hi, bucket))))
    cond = F.col("_r_ts").between(lo, hi) & (F.col("_slot") == F.col("_r_slot"))
    for c, n in names.items():
        cond = cond & (F.col(c) == F.col(n))
    met = a.join(r, cond, "left_outer").select(*cols, F.col("_r_ts").isNotNull().cast("int").alias("_met"))
    folded = met.groupBy(*cols).agg(F.max("_met").alias("_met"))
    return folded.filter("_met = 0").select(*cols)


def _slot(when: Column, bucket: int) -> Column:
    return F.floor(F.unix_seconds(when) / F.lit(bucket))


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, lateness: str = "5 minutes") -> DataFrame:
    """First arrival per key; a key is remembered for ``lateness`` of event time."""
    return with_watermark(df, ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def split_late(df: DataFrame, ts: str, created: str, allowed: int) -> tuple[DataFrame, DataFrame]:
    """``(on time, late)``: late rows were written more than ``allowed`` seconds after the event."""
    gap = F.unix_micros(F.col(created).cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    late = F.coalesce(gap > allowed * 1_000_000, F.lit(False))
    return df.filter(~late), df.filter(late)


def upsert_stream(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Hand each micro-batch of changed rows (update mode) to ``write(batch, epoch)``.

    ``write`` must give the same result when it gets an epoch again.
    """
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def epoch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``write`` for :func:`upsert_stream`: one folder per epoch, replaced on a repeat.

    The current value of a key is its row of the highest epoch (``latest_per_key`` by ``epoch``).
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write
