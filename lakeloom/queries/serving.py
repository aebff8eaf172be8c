"""Business queries."""

from __future__ import annotations

from ..plans import serving
from ..plans.gold import customer_features, order_wide
from ..plans.layers import clean_customers, clean_items, clean_orders
from ..sources.writers import staged
from . import raw
from .sql import customer_90d


def _wide(spark, d, **sides):
    return order_wide(clean_orders(raw.raw_orders(spark, d)), clean_items(raw.raw_items(spark, d)), **sides)


def features_90d(spark, d, **options):
    items = staged(clean_items(raw.raw_items(spark, d)), "clean-items")
    return customer_features(clean_orders(raw.raw_orders(spark, d)), items, raw.raw_products(spark, d), **options)


def revenue_by_region(spark, d):
    return serving.revenue_by_region(_wide(spark, d, stores=raw.raw_stores(spark, d)))


def channel_mix(spark, d):
    return serving.channel_mix(order_wide(clean_orders(raw.raw_orders(spark, d))))


def top_stores(spark, d):
    return serving.top_stores(_wide(spark, d, stores=raw.raw_stores(spark, d)))


def feature_topk_asof(spark, d):
    return serving.top_customers_as_of(features_90d(spark, d), "2001-12-31")


def order_wide_query(spark, d):
    return _wide(
        spark,
        d,
        customers=clean_customers(raw.raw_customers(spark, d)),
        stores=raw.raw_stores(spark, d),
        payments=raw.raw_payments(spark, d),
    )


QUERIES = {
    "revenue_by_region": (
        revenue_by_region,
        """
        SELECT region, count(*) AS orders,
               CAST(round(sum(CAST(order_net_amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue
        FROM wide WHERE status = 'completed' GROUP BY region ORDER BY revenue DESC NULLS LAST, region""",
    ),
    "channel_mix": (
        channel_mix,
        """
        SELECT coalesce(channel, '(pre-app)') AS channel, count(*) AS orders
        FROM stg_orders GROUP BY stg_orders.channel ORDER BY orders DESC, channel""",
    ),
    "top_stores": (
        top_stores,
        """
        SELECT store_id, store_city, CAST(round(sum(CAST(order_net_amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue
        FROM wide GROUP BY store_id, store_city ORDER BY revenue DESC NULLS LAST, store_id LIMIT 5""",
    ),
    "feature_topk_asof": (
        feature_topk_asof,
        f"""
        SELECT customer_id, event_timestamp, f_total_orders_90d, f_avg_order_value_90d
        FROM ({customer_90d("line")}) WHERE event_timestamp <= TIMESTAMP '2001-12-31'
        ORDER BY f_total_orders_90d DESC, customer_id LIMIT 3""",
    ),
    "order_wide": (
        order_wide_query,
        "SELECT w.*, p.payment_status_last, p.payment_method_last FROM wide w LEFT JOIN last_payment p USING (order_id)",
    ),
}
