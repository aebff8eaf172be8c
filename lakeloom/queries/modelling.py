"""Dimensions, facts, amounts and payment attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import line_amount, mapped
from ..operators.ordering import extend_keys
from ..plans import gold
from ..plans.layers import clean_customers, clean_items, clean_orders
from ..plans.payments import numbered, payment_base
from ..sources.writers import staged
from . import raw

DATE_COLUMNS = """
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS calendar_date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
    dayname(d) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend"""


def dim_date(spark, d):
    return gold.dim_date(clean_orders(raw.raw_orders(spark, d)))


def dim_date_full(spark, d):
    return gold.dim_date(clean_orders(raw.raw_orders(spark, d)), full=True)


def dim_customer(spark, d):
    return gold.dim_customer(clean_customers(raw.raw_customers(spark, d)))


def dim_product(spark, d):
    return gold.dim_product(raw.raw_products(spark, d))


def dim_store(spark, d):
    return gold.dim_store(raw.raw_stores(spark, d))


def dim_employee(spark, d):
    return gold.dim_employee(raw.raw_employees(spark, d))


def fact_orders(spark, d):
    return gold.fact_orders(
        clean_orders(raw.raw_orders(spark, d)),
        clean_items(raw.raw_items(spark, d)),
        dim_customer(spark, d),
        dim_store(spark, d),
        dim_employee(spark, d),
    )


def fact_order_items(spark, d):
    items = staged(clean_items(raw.raw_items(spark, d)), "clean-items")
    return gold.fact_order_items(items, clean_orders(raw.raw_orders(spark, d)), dim_product(spark, d))


def line_amounts(spark, d):
    """Size factor, 20 % off on some lines, all rounded to one decimal place."""
    factor = mapped(F.col("l_linenumber") % 4, {1: 1.0, 2: 1.2, 3: 1.4}, 1.0)
    rebate = F.when(F.col("l_orderkey") % 20 < 3, 0.2).otherwise(0.0)
    unit, off, net = line_amount("l_extendedprice", "l_quantity", factor, rebate)
    return raw.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        unit.alias("unit_price"),
        off.alias("discount_amount"),
        net.alias("line_amount"),
    )


def order_totals_zero_filled(spark, d):
    base = payment_base(raw.raw_orders(spark, d), raw.raw_items(spark, d))
    return base.select("order_id", "order_timestamp", "status", "amount", "payment_status")


def attempt_sequence(spark, d):
    rows = raw.raw_attempts(spark, d)
    return numbered(rows, ["payment_timestamp", "order_id", "attempt_no"], "payment_id", "PAY").drop("attempt_no")


def extended_keys(spark, d):
    """Stores 0, 2, 4, ... had keys; the others come later and keep the old keys as they are."""
    stores = raw.raw_stores(spark, d)
    first = gold.dense_key(stores.filter("store_id % 2 = 0").select("store_id"), "store_id", "store_key")
    return extend_keys(stores, first, "store_id", "store_key")


QUERIES = {
    "dim_date": (
        dim_date,
        f"SELECT {DATE_COLUMNS} FROM (SELECT DISTINCT order_date AS d FROM stg_orders WHERE order_date IS NOT NULL)",
    ),
    "dim_date_full": (
        dim_date_full,
        f"""
        SELECT {DATE_COLUMNS}
        FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS d FROM stg_orders)""",
    ),
    "dim_customer": (dim_customer, "SELECT * FROM dim_customer"),
    "dim_product": (dim_product, "SELECT * FROM dim_product"),
    "dim_store": (dim_store, "SELECT * FROM dim_store"),
    "dim_employee": (dim_employee, "SELECT * FROM dim_employee"),
    "fact_orders": (fact_orders, "SELECT * FROM fact_orders"),
    "fact_order_items": (fact_order_items, "SELECT * FROM fact_order_items"),
    "line_amounts": (
        line_amounts,
        """
        WITH priced AS (
            SELECT *, round(CAST(l_extendedprice AS DECIMAL(18,2))
                      * CAST(CASE l_linenumber % 4 WHEN 2 THEN 1.2 WHEN 3 THEN 1.4 ELSE 1.0 END AS DECIMAL(18,2)), 1) AS unit
            FROM lineitem),
        reduced AS (
            SELECT *, unit * CAST(l_quantity AS DECIMAL(10,0)) AS gross,
                   round(unit * CAST(l_quantity AS DECIMAL(10,0))
                         * CAST(CASE WHEN l_orderkey % 20 < 3 THEN 0.2 ELSE 0.0 END AS DECIMAL(18,2)), 1) AS off
            FROM priced)
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(unit AS DOUBLE) AS unit_price,
               CAST(off AS DOUBLE) AS discount_amount, CAST(round(gross - off, 1) AS DOUBLE) AS line_amount
        FROM reduced""",
    ),
    "order_totals_zero_filled": (
        order_totals_zero_filled,
        "SELECT order_id, order_timestamp, status, amount, payment_status FROM payment_base",
    ),
    "attempt_sequence": (
        attempt_sequence,
        """
        SELECT 'PAY' || lpad(CAST(row_number() OVER (ORDER BY payment_timestamp, order_id, attempt_no) AS VARCHAR), 9, '0')
                   AS payment_id, order_id, payment_timestamp, payment_method, amount, payment_status
        FROM attempts""",
    ),
    "extended_keys": (
        extended_keys,
        """
        SELECT store_id, row_number() OVER (ORDER BY store_id % 2, store_id) AS store_key FROM raw_stores""",
    ),
}
