"""Unified features, rolling failure rates, log roll-ups and amounts of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exact_sum, mask_text
from ..functions.columns import TEXT_MASKS
from ..operators.joins import spread_join
from ..operators.ordering import rolling_sums
from ..operators.sketches import RANK_ERROR, hour_table, rank_bounds, rolled_up
from ..plans import gold, views
from ..sources.writers import staged
from . import raw
from .features import DAY_VIEW, day_features, day_labels

HOUR_VIEW = views.FeatureView(
    name="user_hour", keys=("user_id",), created=None, ttl="36 hours", fields={"f_views_1h": "bigint", "f_clicks_1h": "bigint"}
)
ERROR_VIEW = views.FeatureView(
    name="last_error", keys=("user_id",), created=None, ttl="2 days", fields={"f_error_value": "double"}
)


def _hour_features(spark, d):
    """Views and clicks per user and hour, known when the hour is over."""
    rows = raw.table(spark, d, "events").filter("event_type IN ('view', 'click')")
    stamp = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
    counts = [F.count_if(F.col("event_type") == t).alias(f"f_{t}s_1h") for t in ("view", "click")]
    return rows.groupBy("user_id", stamp.alias("event_timestamp")).agg(*counts)


def _error_features(spark, d):
    rows = raw.table(spark, d, "events").filter("event_type = 'error'")
    return rows.select("user_id", F.col("ts").alias("event_timestamp"), F.col("value").alias("f_error_value"))


def unified_features(spark, d):
    """Labels with three feature tables of different age limits, merged in one pass."""
    tables = [(DAY_VIEW, day_features(spark, d)), (HOUR_VIEW, _hour_features(spark, d)), (ERROR_VIEW, _error_features(spark, d))]
    return views.unified_features(day_labels(spark, d), tables, "label_time")


def training_set(spark, d):
    """Labels (was the next purchase worth more than 100?) with the features known at their time."""
    rows = raw.table(spark, d, "events").filter("event_type = 'purchase'")
    labels = rows.select("event_id", "user_id", F.col("ts").alias("label_time"), (F.col("value") > 100).cast("int").alias("label"))
    return views.historical_features(labels, day_features(spark, d), DAY_VIEW, "label_time")


def failure_rate_90d(spark, d):
    """Share of failed payment attempts of each customer in the 90 days up to each attempt."""
    orders = raw.raw_orders(spark, d).select("order_id", "customer_id")
    tries = spread_join(raw.raw_payments(spark, d).select("order_id", "payment_timestamp", "payment_status"), orders, ["order_id"], "inner")
    sums = {"attempts_90d": F.count(F.lit(1)), "failed_90d": F.count_if(F.col("payment_status") == "failed")}
    found = rolling_sums(tries, ["customer_id"], "payment_timestamp", "90 days", sums)
    rate = F.col("failed_90d").cast("double") / F.col("attempts_90d")
    return found.select("customer_id", "payment_timestamp", "attempts_90d", "failed_90d", rate.alias("failure_rate_90d"))


def _requests(spark, d):
    return raw.table(spark, d, "events").select(
        (F.col("event_id") % 4).alias("service"), "ts", "value", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("tokens"),
    )


def log_rollup(spark, d):
    """Requests, errors and tokens per service and day, and whether the p50 and p95 from the hours' sketches
    have a rank within the stated error."""
    rows = _requests(spark, d)
    hours = staged(hour_table(rows, "ts", "value", ["service"], F.col("event_type") == "error", {"tokens": F.col("tokens")}), "log-hours")
    days = rolled_up(hours, ["service"], {"p50": 0.5, "p95": 0.95}, sums=["tokens"]).checkpoint()
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")
    out = days
    for name, share in (("p50", 0.5), ("p95", 0.95)):
        cuts = spread_join(rows.select("service", day, "value"), days.select("service", "day", name), ["service", "day"])
        ranks = rank_bounds(cuts, "value", name, ["service", "day"])
        within = (F.col("rank_low") <= share + 2 * RANK_ERROR) & (F.col("rank_high") >= share - 2 * RANK_ERROR)
        out = out.join(ranks.select("service", "day", within.alias(f"{name}_within")), ["service", "day"])
    return out.select(
        "service", F.col("day").cast("timestamp_ntz").alias("day"), "requests", "errors", "error_rate", "tokens", "p50_within", "p95_within"
    )


def wide_amounts(spark, d):
    """Totals of amounts beyond 1e13 and below 1e-6, exact in both."""
    key = F.col("o_orderkey")
    rows = raw.table(spark, d, "orders").select("o_orderpriority", (key * 1e9).alias("wide"), ((key % 1000) * 4e-10).alias("tiny"))
    return rows.groupBy("o_orderpriority").agg(exact_sum("wide", 2).alias("wide"), exact_sum("tiny", 10).alias("tiny"))


def payment_attempts(spark, d):
    """Attempts with keys of their method and status."""
    paid = raw.raw_payments(spark, d)
    methods, statuses = gold.dim_of(paid, "payment_method", "payment_method_key"), gold.dim_of(paid, "payment_status", "payment_status_key")
    return gold.fact_payment_attempts(paid, raw.raw_orders(spark, d), methods, statuses)


def masked_texts(spark, d):
    """Texts as they may go to a log: how long they are then, and what was masked."""
    rows = raw.table(spark, d, "documents").select("doc_id", mask_text("text").alias("t"))
    marks = [F.regexp_count("t", F.lit(rf"\[{m}\]")).cast("bigint").alias(f"{m}s") for m in ("email", "ip", "number")]
    return rows.select("doc_id", F.md5(F.col("t").cast("binary")).alias("masked_md5"), *marks)


_HOURS = """
    SELECT user_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS event_timestamp,
           count(*) FILTER (WHERE event_type = 'view') AS f_views_1h, count(*) FILTER (WHERE event_type = 'click') AS f_clicks_1h
    FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL"""
_ERRORS = """
    SELECT user_id, ts AS event_timestamp, max(value) AS f_error_value FROM events WHERE event_type = 'error' GROUP BY user_id, ts"""

_MASKED = "text"
for _pattern, _mark in TEXT_MASKS:
    _MASKED = f"regexp_replace({_MASKED}, '{_pattern}', '{_mark}', 'g')"

QUERIES = {
    "payment_attempts": (
        payment_attempts,
        """
        WITH m AS (SELECT payment_method, row_number() OVER (ORDER BY payment_method) AS k FROM (SELECT DISTINCT payment_method FROM raw_payments)),
        s AS (SELECT payment_status, row_number() OVER (ORDER BY payment_status) AS k FROM (SELECT DISTINCT payment_status FROM raw_payments))
        SELECT payment_id, p.order_id, customer_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
               m.k AS payment_method_key, s.k AS payment_status_key,
               CAST(row_number() OVER (PARTITION BY p.order_id ORDER BY payment_timestamp, payment_id) AS INTEGER) AS attempt_no,
               CAST(payment_status = 'success' AS INTEGER) AS is_success, CAST(payment_status = 'failed' AS INTEGER) AS is_failed,
               amount, payment_timestamp
        FROM raw_payments p LEFT JOIN raw_orders o ON o.order_id = p.order_id
        LEFT JOIN m USING (payment_method) LEFT JOIN s USING (payment_status)""",
    ),
    "masked_texts": (
        masked_texts,
        f"""
        SELECT doc_id, md5(t) AS masked_md5, len(regexp_extract_all(t, '\\[email\\]')) AS emails,
               len(regexp_extract_all(t, '\\[ip\\]')) AS ips, len(regexp_extract_all(t, '\\[number\\]')) AS numbers
        FROM (SELECT doc_id, {_MASKED} AS t FROM documents)""",
    ),
    "unified_features": (
        unified_features,
        f"""
        SELECT l.event_id, l.user_id, l.label_time,
               CASE WHEN a.event_timestamp >= l.label_time - INTERVAL 10 DAY THEN a.event_timestamp END AS user_day_time,
               CASE WHEN a.event_timestamp >= l.label_time - INTERVAL 10 DAY THEN a.f_events END AS f_events,
               CASE WHEN a.event_timestamp >= l.label_time - INTERVAL 10 DAY THEN a.f_value END AS f_value,
               CASE WHEN b.event_timestamp >= l.label_time - INTERVAL 36 HOUR THEN b.event_timestamp END AS user_hour_time,
               CASE WHEN b.event_timestamp >= l.label_time - INTERVAL 36 HOUR THEN b.f_views_1h END AS f_views_1h,
               CASE WHEN b.event_timestamp >= l.label_time - INTERVAL 36 HOUR THEN b.f_clicks_1h END AS f_clicks_1h,
               CASE WHEN c.event_timestamp >= l.label_time - INTERVAL 2 DAY THEN c.event_timestamp END AS last_error_time,
               CASE WHEN c.event_timestamp >= l.label_time - INTERVAL 2 DAY THEN c.f_error_value END AS f_error_value
        FROM day_labels l
        ASOF LEFT JOIN day_features a ON l.user_id = a.user_id AND l.label_time >= a.event_timestamp
        ASOF LEFT JOIN ({_HOURS}) b ON l.user_id = b.user_id AND l.label_time >= b.event_timestamp
        ASOF LEFT JOIN ({_ERRORS}) c ON l.user_id = c.user_id AND l.label_time >= c.event_timestamp""",
    ),
    "training_set": (
        training_set,
        """
        SELECT l.event_id, l.user_id, l.label_time, CAST(e.value > 100 AS INTEGER) AS label,
               f.event_timestamp AS feature_time, f.f_events, f.f_value
        FROM day_labels l JOIN events e USING (event_id)
        ASOF JOIN day_features f ON l.user_id = f.user_id AND l.label_time >= f.event_timestamp
        WHERE f.event_timestamp >= l.label_time - INTERVAL 10 DAY""",
    ),
    "failure_rate_90d": (
        failure_rate_90d,
        """
        WITH t AS (
            SELECT customer_id, payment_timestamp, count(*) AS n, count(*) FILTER (WHERE payment_status = 'failed') AS f
            FROM raw_payments JOIN raw_orders USING (order_id) WHERE customer_id IS NOT NULL GROUP BY ALL)
        SELECT customer_id, payment_timestamp, CAST(sum(n) OVER w AS BIGINT) AS attempts_90d, CAST(sum(f) OVER w AS BIGINT) AS failed_90d,
               CAST(sum(f) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE) AS failure_rate_90d
        FROM t WINDOW w AS (PARTITION BY customer_id ORDER BY payment_timestamp
            RANGE BETWEEN INTERVAL '7775999.999999' SECOND PRECEDING AND CURRENT ROW)""",
    ),
    "log_rollup": (
        log_rollup,
        """
        SELECT event_id % 4 AS service, date_trunc('day', ts) AS day, count(*) AS requests,
               count(*) FILTER (WHERE event_type = 'error') AS errors,
               count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS error_rate,
               CAST(sum(CAST(props::JSON ->> '$.k' AS BIGINT)) AS BIGINT) AS tokens, TRUE AS p50_within, TRUE AS p95_within
        FROM events GROUP BY 1, 2""",
    ),
    "wide_amounts": (
        wide_amounts,
        """
        SELECT o_orderpriority, (sum(o_orderkey) * 1000000000)::DOUBLE AS wide, sum(o_orderkey % 1000)::DOUBLE * 4 / 10000000000 AS tiny
        FROM orders GROUP BY o_orderpriority""",
    ),
}
