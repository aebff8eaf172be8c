"""Checks, profiles, injected faults and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import in_hours
from ..operators.aggregates import dup_rate, rate
from ..operators.drift import psi
from ..operators.inject import inject_skew
from ..operators.joins import spread_join
from ..operators.ordering import dense_key
from ..plans import checks, profile
from ..plans.layers import clean_items, clean_orders
from ..sources.writers import staged
from ..streaming.stateful import split_late
from . import modelling, raw


def dq_uniqueness(spark, d):
    return checks.run_checks(
        [
            checks.unique(raw.raw_orders(spark, d), "order_id", "orders"),
            checks.unique(raw.raw_items(spark, d), "order_item_id", "order_items raw"),
            checks.unique(clean_items(raw.raw_items(spark, d)), "order_item_id", "order_items clean"),
        ]
    )


def dq_referential(spark, d):
    """Customers of one segment are left out of the dimension, so some orders have no match."""
    orders = clean_orders(raw.raw_orders(spark, d))
    known = raw.raw_customers(spark, d)
    rows = []
    for name, people in (("all customers", known), ("without MACHINERY", known.filter("membership_tier <> 'MACHINERY'"))):
        keys = people.select("customer_id", F.col("customer_id").alias("customer_key"))
        fact = spread_join(orders, keys, ["customer_id"]).select("order_id", "customer_key")
        rows.append(checks.referential(fact, orders, "order_id", "customer_key", "customer_id", name))
    return checks.run_checks(rows)


def dq_nulls(spark, d):
    orders = clean_orders(raw.raw_orders(spark, d))
    return checks.run_checks(
        [
            checks.required(orders, ["order_id", "order_date"], "order keys"),
            checks.required(orders, ["order_id", "customer_id"], "order customers"),
        ]
    )


def dq_reconcile(spark, d):
    """Items against orders (equal), payments against orders (copies were billed, so not equal)."""
    orders, items = clean_orders(raw.raw_orders(spark, d)), clean_items(raw.raw_items(spark, d))
    totals = modelling.gold.order_wide(orders, items)
    return checks.run_checks(
        [
            checks.reconcile(items, "line_amount", totals, "order_net_amount", "items vs orders", tolerance=1000),
            checks.reconcile(raw.raw_attempts(spark, d), "amount", totals, "order_net_amount", "payments vs orders"),
        ]
    )


def dq_null_split(spark, d):
    return checks.null_split(raw.raw_orders(spark, d), "channel", "channel")


def dq_gold(spark, d):
    """The standing checks over the star schema, which is written first, as in a real run."""
    fact_orders = staged(modelling.fact_orders(spark, d), "fact-orders")
    fact_items = staged(modelling.fact_order_items(spark, d), "fact-order-items")
    return checks.gold_checks(fact_orders, fact_items, clean_orders(raw.raw_orders(spark, d)))


def batch_profile(spark, d):
    return profile.batch_profile(raw.raw_tables(spark, d), raw.PEAK, "ECONOMY")


def stream_profile(spark, d):
    return profile.stream_profile(raw.raw_events(spark, d), raw.BURSTS)


def out_of_order(spark, d):
    rows = profile.out_of_order(raw.raw_events(spark, d), "event_id", "event_timestamp", "created_ts")
    return rows.filter("late_in_order").drop("late_in_order")


def clock_order(spark, d):
    return checks.run_checks(
        [
            checks.clocks_in_order(raw.raw_orders(spark, d), "order_timestamp", "created_ts", "orders"),
            checks.clocks_in_order(raw.raw_events(spark, d), "event_timestamp", "created_ts", "events"),
            checks.clocks_in_order(raw.raw_orders(spark, d), "created_ts", "order_timestamp", "orders reversed"),
        ]
    )


def rate_tolerance(spark, d):
    events = raw.raw_events(spark, d)
    late = rate(profile.is_late("event_timestamp", "created_ts"))
    return checks.run_checks(
        [
            checks.within(events, late, 0.12, 0.03, "late"),
            checks.within(events, dup_rate("event_id"), 0.015, 0.01, "copies"),
            checks.within(events, rate(F.col("customer_id").isNull()), 0.9, 0.1, "anonymous, wrong target"),
            checks.above(events, rate(in_hours("event_timestamp", raw.BURSTS)), 0.1, "burst"),
        ]
    )


def null_implication(spark, d):
    orders = raw.raw_orders(spark, d)
    return checks.run_checks(
        [
            checks.implies_null(orders, "channel", "membership_tier_at_order", "channel then tier"),
            checks.implies_null(orders, "membership_tier_at_order", "channel", "tier then channel"),
        ]
    )


def reproducible(spark, d):
    """The clean items built twice, the second time from rows in another order with every row doubled.

    With the rows and a checksum of the keys, so that two empty tables are not the same. The other order is a
    rebalance, whose tasks get more as the table grows, and not a number of partitions that stays.
    """
    items = raw.raw_items(spark, d)
    shuffled = items.unionByName(items).hint("rebalance", F.col("product_id"))
    clean = clean_items(items)
    same = checks.same_rows(clean, clean_items(shuffled), "clean items")
    return same.select("*", clean.agg(F.count(F.lit(1))).scalar().alias("rows"), clean.agg(F.sum("order_item_id")).scalar().alias("keys"))


def skewed_keys(spark, d):
    orders = raw.table(spark, d, "orders")
    return orders.groupBy(inject_skew("o_orderkey", 75, 8, 1000).alias("store_id")).agg(F.count(F.lit(1)).alias("orders"))


def burst_hours(spark, d):
    rows = raw.raw_orders(spark, d).groupBy(F.hour("order_timestamp").alias("hour"))
    return rows.agg(F.count(F.lit(1)).alias("orders"))


def ingest_order(spark, d):
    """Position of every event in ingest order."""
    rows = raw.clean_source_events(spark, d).select("event_id", "created_ts")
    return dense_key(rows, ["created_ts", "event_id"], "position")


def late_split(spark, d):
    on_time, late = split_late(raw.raw_events(spark, d), "event_timestamp", "created_ts", 300)
    return on_time.withColumn("arrival", F.lit("on time")).unionByName(late.withColumn("arrival", F.lit("late")))


def psi_drift(spark, d):
    orders = raw.table(spark, d, "orders")
    before = F.col("o_orderdate") < F.lit(raw.LAUNCH).cast("timestamp_ntz")
    return psi(orders.filter(before), orders.filter(~before), "o_totalprice")


def _check(name, passed, detail, source):
    return f"""SELECT '{name}' AS "check", {passed} AS passed, {detail} AS detail FROM {source}"""


def _unique(name, key, table):
    return _check(
        name, "n = u", "n || ' rows, ' || u || ' distinct'", f"(SELECT count(*) AS n, count(DISTINCT {key}) AS u FROM {table})"
    )


def _zero(name, what, source):
    return _check(name, "n = 0", f"n || ' {what}'", f"(SELECT count(*) AS n FROM {source})")


def _sums(name, left, right, tolerance):
    def total(pair):
        col, table = pair
        return f"(SELECT CAST(coalesce(round(sum(CAST({col} AS DECIMAL(18,2))), 0), 0) AS BIGINT) FROM {table})"

    return _check(
        name, f"abs(a - b) < {tolerance}", "'left=' || a || ' right=' || b", f"(SELECT {total(left)} AS a, {total(right)} AS b)"
    )


def _rate(name, passed, expr, table="raw_events"):
    return _check(name, passed, "'rate=' || printf('%.4f', r)", f"(SELECT {expr} AS r FROM {table})")


def _all(*parts):
    return "\nUNION ALL\n".join(parts)


_LATE = "CAST(count(*) FILTER (WHERE created_ts - event_timestamp > INTERVAL 5 SECOND) AS DOUBLE) / count(*)"
_BURST = "CAST(count(*) FILTER (WHERE hour(event_timestamp) IN (7, 8, 12)) AS DOUBLE) / count(*)"
_ANON = "CAST(count(*) FILTER (WHERE customer_id IS NULL) AS DOUBLE) / count(*)"
_COPIES = "CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) / count(*)"
_GOLD_NULLS = "fact_orders WHERE order_id IS NULL OR order_date_key IS NULL"
_GOLD_ORPHANS = """fact_orders f JOIN stg_orders o ON f.order_id = o.order_id
    WHERE f.customer_key IS NULL AND o.customer_id IS NOT NULL"""
_RUNNING = """
    SELECT event_id, event_timestamp, created_ts, copies,
           event_timestamp < max(event_timestamp) OVER (ORDER BY created_ts, event_id, event_timestamp
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS disordered
    FROM (SELECT event_id, event_timestamp, created_ts, count(*) AS copies FROM raw_events GROUP BY ALL)"""


def _metric(section, metric, expr, table, targets):
    target = targets.get(metric, "NULL")
    return f"""SELECT '{section}' AS section, '{metric}' AS metric, CAST(({expr}) AS DOUBLE) AS measured,
        CAST({target} AS DOUBLE) AS target FROM {table}"""


def _batch(metric, expr, table):
    return _metric("batch", metric, expr, table, profile.BATCH_TARGETS)


def _stream(metric, expr, table="raw_events"):
    return _metric("stream", metric, expr, table, profile.STREAM_TARGETS)


def _share(cond):
    return f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) / count(*)"


QUERIES = {
    "dq_uniqueness": (
        dq_uniqueness,
        _all(
            _unique("orders", "order_id", "raw_orders"),
            _unique("order_items raw", "order_item_id", "raw_items"),
            _unique("order_items clean", "order_item_id", "stg_items"),
        ),
    ),
    "dq_referential": (
        dq_referential,
        _all(
            _zero("all customers", "orphans", "raw_orders WHERE customer_id NOT IN (SELECT c_custkey FROM customer)"),
            _zero(
                "without MACHINERY",
                "orphans",
                "raw_orders WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')",
            ),
        ),
    ),
    "dq_nulls": (
        dq_nulls,
        _all(
            _zero("order keys", "nulls", "raw_orders WHERE order_id IS NULL OR order_date IS NULL"),
            _zero("order customers", "nulls", "raw_orders WHERE order_id IS NULL OR customer_id IS NULL"),
        ),
    ),
    "dq_reconcile": (
        dq_reconcile,
        _all(
            _sums("items vs orders", ("line_amount", "stg_items"), ("order_net_amount", "wide"), 1000),
            _sums("payments vs orders", ("amount", "attempts"), ("order_net_amount", "wide"), 10),
        ),
    ),
    "dq_null_split": (
        dq_null_split,
        _check(
            "channel",
            "true",
            "'null=' || a || ' not_null=' || b",
            "(SELECT count(*) - count(channel) AS a, count(channel) AS b FROM raw_orders)",
        ),
    ),
    "dq_gold": (
        dq_gold,
        _all(
            _unique("uniqueness fact_orders.order_id", "order_id", "fact_orders"),
            _zero("referential fact_orders -> dim_customer", "orphans", _GOLD_ORPHANS),
            _zero("null required keys fact_orders", "nulls", _GOLD_NULLS),
            _sums(
                "amount reconciliation items vs orders",
                ("line_amount", "fact_order_items"),
                ("order_net_amount", "fact_orders"),
                10,
            ),
            _check(
                "channel before and after launch",
                "true",
                "'null=' || a || ' not_null=' || b",
                "(SELECT count(*) - count(channel) AS a, count(channel) AS b FROM fact_orders)",
            ),
        ),
    ),
    "batch_profile": (
        batch_profile,
        _all(
            _batch(
                "total_rows",
                """(SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) + (SELECT count(*) FROM customer)
                   + (SELECT count(*) FROM raw_employees) + (SELECT count(*) FROM orders)
                   + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM raw_payments)""",
                "(SELECT 1)",
            ),
            _batch(
                "top_store_share",
                "CAST(sum(n) AS DOUBLE) / (SELECT count(*) FROM orders)",
                "(SELECT store_id, count(*) AS n FROM raw_orders GROUP BY store_id ORDER BY n DESC, store_id LIMIT 8)",
            ),
            _batch("peak_hour_share", _share("hour(order_timestamp) IN (7, 8, 9)"), "raw_orders"),
            _batch("channel_null_rate", _share("channel IS NULL"), "raw_orders"),
            _batch("guest_rate", _share("customer_id IS NULL"), "raw_orders"),
            _batch("distinct_orders", "count(DISTINCT order_id)", "raw_orders"),
            _batch("category_share", _share("category = 'ECONOMY'"), "raw_products"),
            _batch("item_duplicate_rate", "CAST(count(*) - count(DISTINCT order_item_id) AS DOUBLE) / count(*)", "raw_items"),
            _batch("city_null_rate", _share("city IS NULL"), "raw_customers"),
        ),
    ),
    "stream_profile": (
        stream_profile,
        _all(
            _stream("total_events", "count(*)"),
            _stream("burst_share", _BURST),
            _stream("late_share", _LATE),
            _stream("duplicate_rate", _COPIES),
            _stream("anonymous_rate", _ANON),
            _stream(
                "out_of_order_share",
                "CAST(sum(CASE WHEN disordered THEN copies ELSE 0 END) AS DOUBLE) / sum(copies)",
                f"({_RUNNING})",
            ),
        ),
    ),
    "out_of_order": (
        out_of_order,
        f"SELECT event_id, event_timestamp, created_ts, copies FROM ({_RUNNING}) WHERE disordered",
    ),
    "clock_order": (
        clock_order,
        _all(
            _zero("orders", "violations", "raw_orders WHERE created_ts < order_timestamp"),
            _zero("events", "violations", "raw_events WHERE created_ts < event_timestamp"),
            _zero("orders reversed", "violations", "raw_orders WHERE order_timestamp < created_ts"),
        ),
    ),
    "rate_tolerance": (
        rate_tolerance,
        _all(
            _rate("late", "abs(r - 0.12) < 0.03", _LATE),
            _rate("copies", "abs(r - 0.015) < 0.01", _COPIES),
            _rate("anonymous, wrong target", "abs(r - 0.9) < 0.1", _ANON),
            _rate("burst", "r > 0.1", _BURST),
        ),
    ),
    "null_implication": (
        null_implication,
        _all(
            _zero(
                "channel then tier",
                "violations",
                "raw_orders WHERE channel IS NULL AND membership_tier_at_order IS NOT NULL",
            ),
            _zero(
                "tier then channel",
                "violations",
                "raw_orders WHERE membership_tier_at_order IS NULL AND channel IS NOT NULL",
            ),
        ),
    ),
    "reproducible": (
        reproducible,
        """
        SELECT 'clean items' AS "check", true AS passed, '0 differing rows' AS detail,
               count(DISTINCT order_item_id) AS rows, sum(DISTINCT order_item_id)::BIGINT AS keys FROM raw_items""",
    ),
    "skewed_keys": (
        skewed_keys,
        """
        SELECT CASE WHEN o_orderkey % 100 < 75 THEN (o_orderkey // 100) % 8 ELSE (o_orderkey * 7919) % 1000 END AS store_id,
               count(*) AS orders
        FROM orders GROUP BY 1""",
    ),
    "burst_hours": (
        burst_hours,
        "SELECT CAST(hour(order_timestamp) AS INTEGER) AS hour, count(*) AS orders FROM raw_orders GROUP BY 1",
    ),
    "ingest_order": (
        ingest_order,
        """
        SELECT event_id, created_ts, row_number() OVER (ORDER BY created_ts, event_id) AS position FROM clean_events""",
    ),
    "late_split": (
        late_split,
        """
        SELECT *, CASE WHEN created_ts - event_timestamp > INTERVAL 300 SECOND THEN 'late' ELSE 'on time' END AS arrival
        FROM raw_events""",
    ),
    "psi_drift": (
        psi_drift,
        f"""
        WITH base AS (SELECT o_totalprice AS v FROM orders WHERE o_orderdate < TIMESTAMP '{raw.LAUNCH}'),
        cur AS (SELECT o_totalprice AS v FROM orders WHERE o_orderdate >= TIMESTAMP '{raw.LAUNCH}'),
        cuts AS (SELECT DISTINCT unnest(quantile_disc(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS cut FROM base),
        cut_list AS (SELECT list(cut) AS l FROM cuts),
        b AS (SELECT len(list_filter(l, lambda c: c < v)) AS bin, count(*) AS n FROM base, cut_list GROUP BY 1),
        c AS (SELECT len(list_filter(l, lambda c: c < v)) AS bin, count(*) AS n FROM cur, cut_list GROUP BY 1),
        pairs AS (SELECT coalesce(b.bin, c.bin) AS bin, coalesce(b.n, 0) AS base_rows, coalesce(c.n, 0) AS cur_rows
                  FROM b FULL JOIN c ON b.bin = c.bin),
        shares AS (SELECT *, greatest(CAST(base_rows AS DOUBLE) / (SELECT sum(base_rows) FROM pairs), 0.0001) AS p,
                          greatest(CAST(cur_rows AS DOUBLE) / (SELECT sum(cur_rows) FROM pairs), 0.0001) AS q
                   FROM pairs),
        parts AS (SELECT *, (q - p) * ln(q / p) AS part FROM shares)
        SELECT CAST(bin AS BIGINT) AS bin, base_rows, cur_rows, round(part, 6) AS psi_part,
               (SELECT round(sum(part), 6) FROM parts) AS psi, (SELECT sum(part) > 0.15 FROM parts) AS drifted
        FROM parts""",
    ),
}
