"""Bronze and Silver: load raw tables, clean them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup, fill
from ..sources.readers import read_merged, read_table

RAW_TABLES = ("stores", "products", "customers", "employees", "order_items", "payments")
LATE_ORDER_COLUMNS = ("channel", "membership_tier_at_order")

Tables = dict[str, DataFrame]


def load_bronze(spark: SparkSession, paths: Mapping[str, str]) -> Tables:
    """Raw tables as they are. ``orders`` is a folder of files with a growing schema.

    ``events`` is optional: the batch tables do not wait for the stream.
    """
    raw = {name: read_table(spark, paths[name]) for name in RAW_TABLES if name in paths}
    if "orders" in paths:
        raw["orders"] = read_merged(spark, paths["orders"], LATE_ORDER_COLUMNS)
    if "events" in paths:
        raw["events"] = read_table(spark, paths["events"])
    return raw


def clean_customers(customers: DataFrame) -> DataFrame:
    return fill(customers, {"city": "unknown"})


def clean_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date", F.to_date("order_date"))


def clean_items(items: DataFrame) -> DataFrame:
    return dedup(items, ["order_item_id"])


def clean_events(events: DataFrame) -> DataFrame:
    """One row per event id, the one that was written first."""
    return dedup(events, ["event_id"], ["created_ts"])


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "order_items": clean_items,
    "events": clean_events,
}


def build_silver(raw: Mapping[str, DataFrame]) -> Tables:
    """Clean tables; whichever raw tables are there."""
    return {name: CLEANERS.get(name, lambda df: df)(df) for name, df in raw.items()}
