"""A small retail data set in the raw schema, with the faults the jobs have to deal with."""

import datetime as dt

DAY0 = dt.datetime(2025, 3, 30)


def tables(spark):
    def at(day, hour=8):
        return DAY0 + dt.timedelta(days=day, hours=hour)

    stores = [("S1", "One", "Hanoi", "North", "cafe"), ("S2", "Two", "Hue", "Central", "kiosk")]
    products = [("P1", "Cocoa", "drinks", 65.0, True, True), ("P2", "Tea", "tea", 45.0, True, True), ("P3", "Mug", "merch", 180.0, False, False)]
    customers = [
        ("C1", "Ann A", "ann@x.test", "Hue", "gold", True, DAY0),
        ("C2", "Bob B", "bob@x.test", None, "none", None, DAY0),
    ]
    employees = [("E1", "Eve", "S1", "barista", True), ("E2", "Dan", "S2", "manager", True)]
    orders = [
        ("O1", "S1", "C1", "E1", at(0), DAY0, None, None, "completed", at(0)),
        ("O2", "S1", "C1", "E1", at(1), DAY0 + dt.timedelta(days=1), None, None, "completed", at(1)),
        ("O3", "S2", None, "E2", at(2), DAY0 + dt.timedelta(days=2), "in_store", None, "completed", at(2)),
        ("O4", "S2", "C2", "E2", at(3), DAY0 + dt.timedelta(days=3), "delivery", "none", "cancelled", at(3)),
        ("O5", "S1", "C1", "E1", at(3), DAY0 + dt.timedelta(days=3), "delivery", "gold", "refunded", at(3)),
    ]
    items = [
        ("I1", "O1", "P1", "S", 1, 65.0, 0.0, 65.0, at(0)),
        ("I2", "O1", "P2", "M", 2, 54.0, 0.0, 108.0, at(0)),
        ("I3", "O1", "P1", "L", 1, 91.0, 18.2, 72.8, at(0)),
        ("I4", "O2", "P3", None, 1, 180.0, 0.0, 180.0, at(1)),
        ("I5", "O3", "P1", "S", 1, 65.0, 0.0, 65.0, at(2)),
        ("I6", "O5", "P9", "S", 1, 10.0, 0.0, 10.0, at(3)),
        ("I2", "O1", "P2", "M", 2, 54.0, 0.0, 108.0, at(0)),
    ]
    payments = [
        ("PAY1", "O1", at(0, 9), "cash", 245.8, "failed", at(0, 9)),
        ("PAY2", "O1", at(0, 9), "card", 245.8, "success", at(0, 9)),
        ("PAY3", "O3", at(2, 9), "cash", 65.0, "success", at(2, 9)),
    ]
    ts = "timestamp_ntz"
    return {
        "stores": spark.createDataFrame(stores, "store_id string, store_name string, city string, region string, store_type string"),
        "products": spark.createDataFrame(
            products, "product_id string, product_name string, category string, base_price double, has_size boolean, is_active boolean"
        ),
        "customers": spark.createDataFrame(
            customers,
            f"customer_id string, full_name string, email string, city string, membership_tier string, marketing_opt_in boolean, signup_ts {ts}",
        ),
        "employees": spark.createDataFrame(employees, "employee_id string, full_name string, store_id string, role string, is_active boolean"),
        "orders": spark.createDataFrame(
            orders,
            f"order_id string, store_id string, customer_id string, employee_id string, order_timestamp {ts}, order_date {ts}, "
            f"channel string, membership_tier_at_order string, status string, created_ts {ts}",
        ),
        "order_items": spark.createDataFrame(
            items,
            "order_item_id string, order_id string, product_id string, size string, quantity long, unit_price double, "
            f"discount_amount double, line_amount double, created_ts {ts}",
        ),
        "payments": spark.createDataFrame(
            payments,
            f"payment_id string, order_id string, payment_timestamp {ts}, payment_method string, amount double, "
            f"payment_status string, created_ts {ts}",
        ),
    }
