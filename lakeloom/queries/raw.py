"""The test tables in the shape of the retail raw tables.

What the test tables lack (guests, launch date, copies, late rows, ...) is added by rules on the
row key, so the SQL twins in ``sql.py`` can build the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import amount, cents, mapped, net_cents, plus_seconds
from ..operators.inject import absent_before, inject_burst, inject_copies, inject_late, inject_nulls, inject_skew
from ..plans.payments import attempts, payment_base

LAUNCH = "1998-01-01"
HOURS = list(range(6, 23))
PEAK = ["07:00-10:00"]
PEAK_WEIGHTS = [6 if 7 <= h < 10 else 1 for h in HOURS]
BURSTS = ["07:00-09:00", "12:00-13:00"]
EVENT_TYPES = {
    "view": "app_view",
    "click": "add_to_cart",
    "purchase": "mobile_order_placed",
    "signup": "store_checkin",
    "error": "payment_failed",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, d: str) -> DataFrame:
    """Nation and region names by nation key: as many rows as there are nations."""
    region = table(spark, d, "region")
    return table(spark, d, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")


def raw_stores(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("s_nationkey") == F.col("n_nationkey")
    return table(spark, d, "supplier").join(places(spark, d), at, "left").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        mapped(F.col("s_suppkey") % 3, {0: "cafe", 1: "kiosk"}, "drive_thru").alias("store_type"),
    )


def raw_products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
        (F.col("p_size") > 25).alias("has_size"),
        (F.col("p_partkey") % 20 != 0).alias("is_active"),
    )


def raw_customers(spark: SparkSession, d: str) -> DataFrame:
    start = F.lit("1994-01-01").cast("timestamp_ntz")
    rows = table(spark, d, "customer").join(places(spark, d), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@example.test")).alias("email"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("membership_tier"),
        (F.col("c_custkey") % 5 < 3).alias("marketing_opt_in"),
        plus_seconds(start, (F.col("c_custkey") * 7919) % 31536000).alias("signup_ts"),
    )
    rows = inject_nulls(rows, "customer_id", "city", 100)
    return inject_nulls(rows, "customer_id", "marketing_opt_in", 100, rest=(1,))


def raw_employees(spark: SparkSession, d: str) -> DataFrame:
    """Four per store."""
    roles = {0: "barista", 1: "cashier", 2: "shift_lead"}
    rows = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    return rows.select(
        (F.col("s_suppkey") * 4 + F.col("k")).alias("employee_id"),
        F.format_string("Employee %d/%d", "s_suppkey", "k").alias("full_name"),
        F.col("s_suppkey").alias("store_id"),
        mapped("k", roles, "manager").alias("role"),
        (F.col("s_suppkey") % 10 != 3).alias("is_active"),
    )


def raw_orders(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    n_stores = table(spark, d, "supplier").agg(F.count(F.lit(1))).scalar()
    store = inject_skew("o_orderkey", 75, 8, n_stores)
    guest = key % 10 < 3
    second = inject_burst("o_orderkey", HOURS, PEAK_WEIGHTS) * 3600 + (key * 31) % 3600
    tier = F.when(~guest, F.concat(F.lit("tier-"), (F.col("o_custkey") % 3).cast("string")))
    rows = table(spark, d, "orders").select(
        key.alias("order_id"),
        store.alias("store_id"),
        F.when(~guest, F.col("o_custkey")).alias("customer_id"),
        (store * 4 + key % 4).alias("employee_id"),
        plus_seconds("o_orderdate", second).alias("order_timestamp"),
        F.col("o_orderdate").alias("order_date"),
        absent_before("o_orderdate", LAUNCH, "o_orderpriority").alias("channel"),
        F.when(F.col("o_orderdate") >= F.lit(LAUNCH).cast("timestamp_ntz"), tier).alias("membership_tier_at_order"),
        mapped("o_orderstatus", {"F": "completed", "O": "refunded"}, "cancelled").alias("status"),
    )
    return rows.withColumn("created_ts", plus_seconds("order_timestamp", F.col("order_id") % 300))


def raw_items(spark: SparkSession, d: str) -> DataFrame:
    """``order_item_id`` repeats in the test data, not always as an exact copy."""
    line = F.col("l_linenumber")
    price, part_off = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 8 + line).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(line % 4 == 1, "S").when(line % 4 == 2, "M").when(line % 4 == 3, "L").alias("size"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        price.alias("unit_price"),
        amount(cents(price) - net_cents(price, part_off)).alias("discount_amount"),
        amount(net_cents(price, part_off)).alias("line_amount"),
        F.col("l_shipdate").alias("created_ts"),
    )


def raw_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Payment attempts without ids. Amounts come from the raw lines, copies included."""
    key = F.col("order_id")
    return attempts(
        payment_base(raw_orders(spark, d), raw_items(spark, d)),
        method=mapped(key % 4, {0: "card", 1: "cash", 2: "wallet"}, "giftcard"),
        paid_at=plus_seconds("order_timestamp", 30 + key % 570),
        retry=key % 20 == 7,
        failed_at=plus_seconds("order_timestamp", 5 + key % 20),
    )


def raw_payments(spark: SparkSession, d: str) -> DataFrame:
    """Attempts under an id that sorts like (order, attempt)."""
    rows = raw_attempts(spark, d)
    return rows.withColumn("payment_id", F.col("order_id") * 2 + F.col("attempt_no")).drop("attempt_no")


def clean_source_events(spark: SparkSession, d: str) -> DataFrame:
    """Events with write time and optional fields, each once."""
    key, kind = F.col("event_id"), F.col("event_type")
    rows = table(spark, d, "events").withColumn("event_type", mapped("event_type", EVENT_TYPES, "order_picked_up"))
    rows = inject_late(rows, "event_id", "ts", "created_ts")
    priced = kind.isin("add_to_cart", "mobile_order_placed", "payment_failed")
    return rows.select(
        "event_id",
        "event_type",
        F.col("ts").alias("event_timestamp"),
        "created_ts",
        F.when(key % 5 >= 2, F.col("user_id")).alias("customer_id"),
        (key % 10).alias("store_id"),
        F.concat(F.lit("sess_"), F.lpad(F.lower(F.hex((key * 7919) % 65536)), 8, "0")).alias("session_id"),
        mapped(key % 3, {0: "app", 1: "web"}, "kiosk").alias("device_type"),
        mapped(key % 4, {0: "mobile_app", 1: "web"}, "in_store").alias("channel"),
        F.when(kind.isin("app_view", "add_to_cart"), key % 200).alias("product_id"),
        F.when(kind.isin("mobile_order_placed", "order_picked_up", "payment_failed"), key % 1500).alias("order_id"),
        F.when(priced, (key % 3 + 1).cast("int")).alias("quantity"),
        F.when(priced, F.col("value")).alias("price"),
    )


def raw_events(spark: SparkSession, d: str) -> DataFrame:
    """Events with some exact copies."""
    return inject_copies(clean_source_events(spark, d), "event_id", 67)


def raw_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "stores": raw_stores(spark, d),
        "products": raw_products(spark, d),
        "customers": raw_customers(spark, d),
        "employees": raw_employees(spark, d),
        "orders": raw_orders(spark, d),
        "order_items": raw_items(spark, d),
        "payments": raw_payments(spark, d),
    }
