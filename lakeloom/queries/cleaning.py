"""Cleaning, schema evolution and JSON messages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ..operators.aggregates import row_counts
from ..operators.dedup import dedup_report, latest_per_key
from ..operators.joins import keys_without_rows as key_difference
from ..plans.layers import LATE_ORDER_COLUMNS, clean_customers, clean_events, clean_items
from ..session import scratch
from ..sources.messages import decode_json, encode_json, to_messages
from ..sources.readers import read_json_lines, read_merged
from ..sources.writers import write_monthly, write_ndjson
from . import raw

EVENT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("event_type", StringType()),
        StructField("event_timestamp", TimestampNTZType()),
        StructField("created_ts", TimestampNTZType()),
        StructField("customer_id", LongType()),
        StructField("store_id", LongType()),
        StructField("session_id", StringType()),
        StructField("device_type", StringType()),
        StructField("channel", StringType()),
        StructField("product_id", LongType()),
        StructField("order_id", LongType()),
        StructField("quantity", IntegerType()),
        StructField("price", DoubleType()),
    ]
)
CLOCKS = ["event_timestamp", "created_ts"]
SECONDS_SQL = """
    SELECT * REPLACE (date_trunc('second', event_timestamp) AS event_timestamp,
                      date_trunc('second', created_ts) AS created_ts)"""


def dedup_items(spark, d):
    return clean_items(raw.raw_items(spark, d))


def dedup_events(spark, d):
    return clean_events(raw.raw_events(spark, d))


def dedup_counts(spark, d):
    items = dedup_report(raw.raw_items(spark, d), ["order_item_id"], "order_items")
    return items.unionByName(dedup_report(raw.raw_events(spark, d), ["event_id"], "events"))


def latest_event_per_user(spark, d):
    rows = raw.raw_events(spark, d).filter(F.col("customer_id").isNotNull())
    return latest_per_key(rows, ["customer_id"], ["event_timestamp", "created_ts", "event_id"])


def fill_missing(spark, d):
    return clean_customers(raw.raw_customers(spark, d))


def schema_merge_read(spark, d):
    """Orders written by month with the late columns missing before launch, then read as one table."""
    path = scratch(spark, "orders-by-month")
    write_monthly(raw.raw_orders(spark, d), "order_date", path, raw.LAUNCH, LATE_ORDER_COLUMNS)
    return read_merged(spark, path, LATE_ORDER_COLUMNS).drop("ym")


def keys_without_rows(spark, d):
    orders = raw.raw_orders(spark, d).select("order_id")
    return key_difference(orders, raw.raw_items(spark, d).select("order_id"), "order_id")


def json_roundtrip(spark, d):
    """Events written as JSON lines in ingest order and read back in the declared schema."""
    path = scratch(spark, "events-ndjson")
    write_ndjson(raw.raw_events(spark, d), path, CLOCKS, ["created_ts", "event_id"])
    return read_json_lines(spark, path, EVENT_SCHEMA)


def _damaged(spark, d):
    """Lines of a file where every 50th event is cut off, has text for a number, or is blank."""
    rows = raw.clean_source_events(spark, d)
    text = encode_json(rows, CLOCKS)
    key = F.col("event_id")
    value = (
        F.when(key % 50 == 0, F.concat(F.lit('{"event_id": '), key.cast("string")))
        .when(key % 50 == 1, F.regexp_replace(text, '"store_id":[0-9]+', '"store_id":"none"'))
        .when(key % 50 == 2, F.lit("  "))
        .otherwise(text)
    )
    path = scratch(spark, "damaged-lines")
    rows.select(value.alias("value")).write.text(path)
    return spark.read.text(path)


def json_lenient(spark, d):
    good, _ = decode_json(_damaged(spark, d), "value", EVENT_SCHEMA)
    return good


def json_quarantine(spark, d):
    _, bad = decode_json(_damaged(spark, d), "value", EVENT_SCHEMA)
    return bad


def keyed_messages(spark, d):
    """First 1000 messages of the replay, with fields taken back out of the text."""
    sent = to_messages(raw.raw_events(spark, d), "event_id", CLOCKS, ["created_ts", "event_id"], limit=1000)
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return sent.select(
        "key",
        field("event_type").alias("event_type"),
        field("created_ts").alias("created_ts"),
        field("customer_id").cast("bigint").alias("customer_id"),
        F.col("value").contains('"customer_id"').alias("has_customer"),
    )


def table_sizes(spark, d):
    return row_counts(raw.raw_tables(spark, d))


QUERIES = {
    "dedup_items": (dedup_items, "SELECT * FROM stg_items"),
    "dedup_events": (dedup_events, "SELECT * FROM clean_events"),
    "dedup_report": (
        dedup_counts,
        """
        SELECT 'order_items' AS table_name, count(*) AS rows_before, count(DISTINCT order_item_id) AS rows_after,
               count(*) - count(DISTINCT order_item_id) AS rows_dropped FROM raw_items
        UNION ALL
        SELECT 'events', count(*), count(DISTINCT event_id), count(*) - count(DISTINCT event_id) FROM raw_events""",
    ),
    "latest_per_key": (
        latest_event_per_user,
        """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id
                       ORDER BY event_timestamp DESC, created_ts DESC, event_id DESC) AS rn
            FROM raw_events WHERE customer_id IS NOT NULL)
        WHERE rn = 1""",
    ),
    "fill_missing": (fill_missing, "SELECT * FROM stg_customers"),
    "schema_merge_read": (schema_merge_read, "SELECT * FROM raw_orders"),
    "keys_without_rows": (
        keys_without_rows,
        "SELECT o_orderkey AS order_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
    ),
    "json_roundtrip": (json_roundtrip, f"{SECONDS_SQL} FROM raw_events"),
    "json_lenient": (
        json_lenient,
        f"""
        SELECT * REPLACE (CASE WHEN event_id % 50 <> 1 THEN store_id END AS store_id)
        FROM ({SECONDS_SQL} FROM clean_events) WHERE event_id % 50 NOT IN (0, 2)""",
    ),
    "json_quarantine": (
        json_quarantine,
        """SELECT '{"event_id": ' || event_id AS value FROM events WHERE event_id % 50 = 0""",
    ),
    "keyed_messages": (
        keyed_messages,
        """
        SELECT CAST(event_id AS VARCHAR) AS "key", event_type, strftime(created_ts, '%Y-%m-%dT%H:%M:%S') AS created_ts,
               customer_id, customer_id IS NOT NULL AS has_customer
        FROM (SELECT * FROM raw_events ORDER BY created_ts, event_id LIMIT 1000)""",
    ),
    "table_sizes": (
        table_sizes,
        """
        SELECT 'stores' AS table_name, count(*) AS row_count FROM supplier
        UNION ALL SELECT 'products', count(*) FROM part
        UNION ALL SELECT 'customers', count(*) FROM customer
        UNION ALL SELECT 'employees', 4 * count(*) FROM supplier
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'order_items', count(*) FROM lineitem
        UNION ALL SELECT 'payments', count(*) FROM raw_payments""",
    ),
}
