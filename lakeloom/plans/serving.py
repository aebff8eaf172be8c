"""Business queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators.aggregates import ranked, top_k
from ..operators.asof import features_as_of


def revenue_by_region(wide: DataFrame, status: str = "completed") -> DataFrame:
    grouped = wide.filter(F.col("status") == status).groupBy("region")
    rows = grouped.agg(F.count(F.lit(1)).alias("orders"), exact_sum("order_net_amount", 0).alias("revenue"))
    return ranked(rows, "revenue", ["region"])


def channel_mix(wide: DataFrame, missing: str = "(pre-app)") -> DataFrame:
    """Orders per channel; NULL is its own group and gets a label."""
    rows = wide.groupBy("channel").agg(F.count(F.lit(1)).alias("orders"))
    return ranked(rows.select(F.coalesce("channel", F.lit(missing)).alias("channel"), "orders"), "orders", ["channel"])


def top_stores(wide: DataFrame, k: int = 5) -> DataFrame:
    rows = wide.groupBy("store_id", "store_city").agg(exact_sum("order_net_amount", 0).alias("revenue"))
    return top_k(rows, "revenue", k, ["store_id"])


def top_customers_as_of(feats: DataFrame, ts: str, k: int = 3) -> DataFrame:
    """Customers with the most orders among the features known at ``ts``."""
    known = features_as_of(feats, "event_timestamp", ts)
    rows = known.select("customer_id", "event_timestamp", "f_total_orders_90d", "f_avg_order_value_90d")
    return top_k(rows, "f_total_orders_90d", k, ["customer_id"])
