"""Profiles: a long table ``(section, metric, measured, target)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_hours
from ..operators.aggregates import dup_rate, rate, share_of_top
from ..operators.ordering import running_max

BATCH_TARGETS = {
    "top_store_share": 0.75,
    "peak_hour_share": 0.55,
    "category_share": 0.70,
    "channel_null_rate": 0.50,
    "item_duplicate_rate": 0.02,
    "city_null_rate": 0.01,
    "guest_rate": 0.30,
}
STREAM_TARGETS = {"late_share": 0.12, "duplicate_rate": 0.015, "anonymous_rate": 0.40}


def _long(df: DataFrame, section: str, targets: Mapping[str, float]) -> DataFrame:
    """One-row frame of metrics to one row per metric."""
    cells = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(c).alias("metric"),
            F.col(c).cast("double").alias("measured"),
            F.lit(targets.get(c)).cast("double").alias("target"),
        )
        for c in df.columns
    ]
    return df.select(F.inline(F.array(*cells)))


def batch_profile(
    tables: Mapping[str, DataFrame],
    peak: Sequence[str],
    category: str,
    top_n: int = 8,
    targets: Mapping[str, float] = BATCH_TARGETS,
) -> DataFrame:
    """Size, skew, missing values and copies of the raw tables, one pass per table and grouping."""
    orders, items = tables["orders"], tables["order_items"]
    counts = None
    for df in tables.values():
        n = df.agg(F.count(F.lit(1)).alias("n"))
        counts = n if counts is None else counts.unionByName(n)
    parts = [
        counts.agg(F.sum("n").alias("total_rows")),
        share_of_top(orders, "store_id", top_n).withColumnRenamed("share", "top_store_share"),
        orders.agg(
            rate(in_hours("order_timestamp", peak)).alias("peak_hour_share"),
            rate(F.col("channel").isNull()).alias("channel_null_rate"),
            rate(F.col("customer_id").isNull()).alias("guest_rate"),
            F.countDistinct("order_id").alias("distinct_orders"),
        ),
        tables["products"].agg(rate(F.col("category") == category).alias("category_share")),
        items.agg(dup_rate("order_item_id").alias("item_duplicate_rate")),
        tables["customers"].agg(rate(F.col("city").isNull()).alias("city_null_rate")),
    ]
    long = None
    for part in parts:
        rows = _long(part, "batch", targets)
        long = rows if long is None else long.unionByName(rows)
    return long


def is_late(ts: str, created: str, seconds: int = 5) -> Column:
    gap = F.unix_micros(F.col(created).cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    return gap > seconds * 1_000_000


def out_of_order(events: DataFrame, id_col: str, ts: str, created: str) -> DataFrame:
    """Events that happened before one that was written earlier; ``copies`` counts equal rows."""
    rows = events.groupBy(created, id_col, ts).agg(F.count(F.lit(1)).alias("copies"))
    seen = running_max(rows, ts, [created, id_col, ts], "_seen")
    return seen.withColumn("late_in_order", F.col(ts) < F.col("_seen")).drop("_seen")


def stream_profile(
    events: DataFrame,
    bursts: Sequence[str],
    targets: Mapping[str, float] = STREAM_TARGETS,
) -> DataFrame:
    """Size, bursts, delays, disorder, copies and anonymous rows of an event table."""
    simple = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        rate(in_hours("event_timestamp", bursts)).alias("burst_share"),
        rate(is_late("event_timestamp", "created_ts")).alias("late_share"),
        dup_rate("event_id").alias("duplicate_rate"),
        rate(F.col("customer_id").isNull()).alias("anonymous_rate"),
    )
    order = out_of_order(events, "event_id", "event_timestamp", "created_ts").agg(
        (
            F.sum(F.when(F.col("late_in_order"), F.col("copies")).otherwise(0)).cast("double") / F.sum("copies")
        ).alias("out_of_order_share")
    )
    return _long(simple, "stream", targets).unionByName(_long(order, "stream", targets))


def daily_health(df: DataFrame, ts: str, stale_after: int = 3600, deviations: float = 3.0) -> DataFrame:
    """Per day: ``events``, ``stale`` (its last row is more than ``stale_after`` seconds before midnight) and
    ``odd_volume`` (its rows are more than ``deviations`` standard deviations from the mean of all days).

    Rows without a time count for no day. The days' mean and deviation are computed once, from one row per day.
    """
    known = df.filter(F.col(ts).isNotNull())
    days = known.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("_last"))
    spread = days.agg(F.avg("events").alias("m"), F.stddev_pop("events").alias("s"))
    m, s = (spread.select(c).scalar() for c in ("m", "s"))
    left = F.unix_seconds(F.date_add("day", 1).cast("timestamp")) - F.unix_seconds(F.col("_last").cast("timestamp"))
    return days.select("day", "events", (left > stale_after).alias("stale"), (F.abs(F.col("events") - m) > deviations * s).alias("odd_volume"))
