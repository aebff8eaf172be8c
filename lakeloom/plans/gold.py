"""Gold: dimensions, facts, the wide order table and the customer feature table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar_columns, date_key, exact, exact_type, mask_email, mean_half_up
from ..operators.dedup import latest_attrs
from ..operators.joins import chain_join, order_totals, star_join
from ..operators.ordering import dense_key
from .layers import Tables

# --- dimensions ------------------------------------------------------------------------


def dim_date(orders: DataFrame, date_col: str = "order_date", full: bool = False) -> DataFrame:
    """One row per day that has orders; ``full`` gives every day between the first and the last."""
    days = orders.filter(F.col(date_col).isNotNull()).select(F.to_date(date_col).alias("d")).distinct()
    if full:
        span = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter(F.col("lo").isNotNull())
        days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_columns("d"))


def dim_customer(customers: DataFrame) -> DataFrame:
    """No full name, and the e-mail only masked."""
    kept = customers.select(
        "customer_id",
        "city",
        "membership_tier",
        "marketing_opt_in",
        "signup_ts",
        mask_email("email").alias("email_masked"),
    )
    return dense_key(kept, "customer_id", "customer_key")


def dim_product(products: DataFrame) -> DataFrame:
    kept = products.select("product_id", "product_name", "category", "base_price", "is_active")
    return dense_key(kept, "product_id", "product_key")


def dim_store(stores: DataFrame) -> DataFrame:
    kept = stores.select("store_id", "store_name", "city", "region", "store_type")
    return dense_key(kept, "store_id", "store_key")


def dim_employee(employees: DataFrame) -> DataFrame:
    return dense_key(employees.select("employee_id", "role", "store_id"), "employee_id", "employee_key")


# --- facts -----------------------------------------------------------------------------


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    stores: DataFrame,
    employees: DataFrame,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per order; the three dimension frames carry id and key.

    ``totals`` are the lines' :func:`order_totals` where another table needs them too and has them already.
    """
    slim = orders.select(
        "order_id",
        "customer_id",
        "store_id",
        "employee_id",
        date_key("order_date").alias("order_date_key"),
        "status",
        "channel",
        "order_timestamp",
        "created_ts",
    )
    keyed = star_join(
        slim,
        [
            (customers, "customer_id", ["customer_key"]),
            (stores, "store_id", ["store_key"]),
            (employees, "employee_id", ["employee_key"]),
        ],
    )
    if totals is None:
        totals = order_totals(items, "order_id", "line_amount")
    return keyed.join(totals, "order_id", "left").select(
        "order_id",
        "customer_key",
        "store_key",
        "employee_key",
        "order_date_key",
        "status",
        "channel",
        "order_timestamp",
        "created_ts",
        "item_count",
        "order_net_amount",
    )


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line that has an order."""
    days = orders.select("order_id", date_key("order_date").alias("order_date_key"))
    named = products.select("product_id", "product_key")
    keyed = chain_join(items, [(named, "product_id", "left"), (days, "order_id", "inner")])
    return keyed.select(
        "order_item_id",
        "order_id",
        "product_key",
        "order_date_key",
        "size",
        "quantity",
        "unit_price",
        "discount_amount",
        "line_amount",
    )


def dim_of(rows: DataFrame, column: str, key: str) -> DataFrame:
    """A small dimension of the values of one column, numbered in their order; NULL gets no key."""
    return dense_key(rows.select(column).filter(F.col(column).isNotNull()).distinct(), column, key)


def fact_payment_attempts(payments: DataFrame, orders: DataFrame, methods: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row per attempt with its number within the order, flags and keys; the dimensions carry value and key.

    Attempts are numbered by time, then id. An attempt without an order stays, without order attributes.
    """
    numbered = payments.withColumn(
        "attempt_no", F.row_number().over(Window.partitionBy("order_id").orderBy("payment_timestamp", "payment_id"))
    )
    slim = orders.select("order_id", "customer_id", date_key("order_date").alias("order_date_key"))
    keyed = chain_join(numbered, [(slim, "order_id", "left"), (methods, "payment_method", "left"), (statuses, "payment_status", "left")])
    flag = lambda status: F.coalesce((F.col("payment_status") == status).cast("int"), F.lit(0))
    return keyed.select(
        "payment_id", "order_id", "customer_id", "order_date_key", "payment_method_key", "payment_status_key", "attempt_no",
        flag("success").alias("is_success"), flag("failed").alias("is_failed"), "amount", "payment_timestamp",
    )


def last_payment(payments: DataFrame) -> DataFrame:
    """Status and method of the last attempt, both from the same row."""
    return latest_attrs(
        payments,
        "order_id",
        ["payment_timestamp", "payment_id"],
        {"payment_status": "payment_status_last", "payment_method": "payment_method_last"},
    )


def order_wide(
    orders: DataFrame,
    items: DataFrame | None = None,
    customers: DataFrame | None = None,
    stores: DataFrame | None = None,
    payments: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per order with what a report needs; a source that is not given is left out.

    ``totals`` are the lines' :func:`order_totals`, where they are there already.
    """
    wide = orders.select("order_id", "order_timestamp", "order_date", "channel", "status", "customer_id", "store_id")
    lookups = []
    if customers is not None:
        people = customers.withColumnRenamed("city", "customer_city")
        lookups.append((people.withColumn("_known", F.lit(True)), "customer_id", ["customer_city", "membership_tier", "_known"]))
    if stores is not None:
        shops = stores.withColumnRenamed("city", "store_city")
        lookups.append((shops.withColumn("_open", F.lit(True)), "store_id", ["store_city", "region", "_open"]))
    if lookups:
        wide = star_join(wide, lookups)
    # As in any left join to a dimension, an id without a dimension row shows as NULL.
    if customers is not None:
        wide = wide.withColumn("customer_id", F.when(F.col("_known"), F.col("customer_id"))).drop("_known")
    if stores is not None:
        wide = wide.withColumn("store_id", F.when(F.col("_open"), F.col("store_id"))).drop("_open")
    if totals is None and items is not None:
        totals = order_totals(items, "order_id", "line_amount")
    if totals is not None:
        wide = wide.join(totals, "order_id", "left")
    if payments is not None:
        wide = wide.join(last_payment(payments), "order_id", "left")
    return wide


# --- features --------------------------------------------------------------------------


def customer_features(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    ref: str | None = None,
    days: int = 90,
    grain: str = "line",
    stamp: str = "start",
    status: str | None = None,
) -> DataFrame:
    """Orders, average order value and distinct categories per customer in the last ``days``.

    The window is ``(ref - days, ref]``; ``ref`` defaults to the last order date. ``grain="line"``
    weights each order by its number of lines, ``"order"`` counts it once. ``stamp="start"`` dates
    the feature at the start of the reference day (the day's own orders are then visible a few
    hours early), ``"end"`` at the next midnight.
    """
    if grain not in ("line", "order") or stamp not in ("start", "end"):
        raise ValueError("grain must be line or order, stamp must be start or end")
    last_day = F.lit(ref).cast("date") if ref else orders.agg(F.max(F.to_date("order_date"))).scalar()
    day = F.to_date("order_date")
    recent = orders.filter(F.col("customer_id").isNotNull() & (day > F.date_sub(last_day, days)) & (day <= last_day))
    if status:
        recent = recent.filter(F.col("status") == status)
    recent = recent.select("order_id", "customer_id")

    named = products.select("product_id", "category", F.lit(1).alias("_listed"))
    lines = items.select("order_id", "product_id", "line_amount")
    lines = chain_join(lines, [(recent, "order_id", "inner"), (named, "product_id", "left")])

    # One pass over the lines for both groupings: orders of a customer, categories of a customer.
    sets = lines.groupingSets(
        [["customer_id", "order_id"], ["customer_id", "category"]], "customer_id", "order_id", "category"
    ).agg(
        F.sum(exact("line_amount", exact_type(items, "line_amount"))).alias("total"),
        F.count("_listed").alias("listed"),
        (F.grouping("category") == 1).alias("is_order"),
    )
    weight = F.col("listed") if grain == "line" else F.lit(1)
    order = F.col("is_order")
    per_customer = (
        sets.filter("listed > 0")
        .groupBy("customer_id")
        .agg(
            F.count_if(order).alias("n_orders"),
            F.sum(F.when(order, F.col("total").cast("decimal(28,9)") * weight.cast("decimal(10,0)"))).alias("weighted"),
            # As in any average, an order without an amount does not count.
            F.sum(F.when(order & F.col("total").isNotNull(), weight)).alias("weight"),
            F.count_if(~order & F.col("category").isNotNull()).alias("n_categories"),
        )
    )
    stamp_day = last_day if stamp == "start" else F.date_add(last_day, 1)
    return per_customer.select(
        "customer_id",
        stamp_day.cast("timestamp_ntz").alias("event_timestamp"),
        F.col("n_orders").alias("f_total_orders_90d"),
        mean_half_up(F.col("weighted") * 10**9, "weight", scale=9).alias("f_avg_order_value_90d"),
        F.col("n_categories").alias("f_distinct_categories_90d"),
    )


# --- all of it -------------------------------------------------------------------------


def build_gold(clean: Mapping[str, DataFrame]) -> Tables:
    """Every gold table. Write the dimensions before the facts when their keys are to be kept."""
    dims = {
        "dim_date": dim_date(clean["orders"]),
        "dim_customer": dim_customer(clean["customers"]),
        "dim_product": dim_product(clean["products"]),
        "dim_store": dim_store(clean["stores"]),
        "dim_employee": dim_employee(clean["employees"]),
    }
    return dims | build_facts(clean, dims)


def build_facts(clean: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> Tables:
    return {name: plan() for name, plan in fact_plans(clean, lambda: dims).items()}


def fact_plans(
    clean: Mapping[str, DataFrame],
    dims: Callable[[], Mapping[str, DataFrame]],
    totals: Callable[[], DataFrame | None] = lambda: None,
) -> dict[str, Callable[[], DataFrame]]:
    """The facts and features, each made when it is called for: that looks at sizes and keys of its inputs.

    ``dims`` and ``totals`` are called by those that need them, so the others do not wait.
    """
    orders, items = clean["orders"], clean["order_items"]

    def orders_fact():
        d = dims()
        return fact_orders(orders, items, d["dim_customer"], d["dim_store"], d["dim_employee"], totals())

    return {  # the one with the largest shuffles first, for writers that go one by one
        "fact_order_items": lambda: fact_order_items(items, orders, dims()["dim_product"]),
        "obt_order_performance": lambda: order_wide(
            orders, items, clean["customers"], clean["stores"], clean["payments"], totals()
        ),
        "fact_orders": orders_fact,
        "feat_customer_90d": lambda: customer_features(orders, items, clean["products"]),
    }
