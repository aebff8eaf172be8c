"""Feature tables, point-in-time joins and online lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators.ordering import rolling_count
from ..plans import views
from . import raw
from .serving import features_90d
from .sql import customer_90d

DAY_VIEW = views.FeatureView(
    name="user_day",
    keys=("user_id",),
    ttl="10 days",
    fields={"f_events": "bigint", "f_value": "double"},
)
START, END = "2024-01-05", "2024-01-20"


def day_features(spark, d):
    """Events and value per user and day, stamped at the next midnight."""
    rows = raw.table(spark, d, "events").filter("event_type <> 'purchase'")
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    stamp = F.col("day") + F.expr("INTERVAL 1 DAY")
    sums = rows.groupBy("user_id", day.alias("day")).agg(
        F.count(F.lit(1)).alias("f_events"), exact_sum("value", 2).alias("f_value")
    )
    return sums.select(
        "user_id",
        stamp.alias("event_timestamp"),
        (stamp + F.make_dt_interval(hours=(F.col("user_id") % 3).cast("int"))).alias("created_timestamp"),
        "f_events",
        "f_value",
    )


def day_labels(spark, d):
    rows = raw.table(spark, d, "events").filter("event_type = 'purchase'")
    return rows.select("event_id", "user_id", F.col("ts").alias("label_time"))


def customer_90d_line(spark, d):
    return features_90d(spark, d)


def customer_90d_order(spark, d):
    return features_90d(spark, d, grain="order")


def historical_features(spark, d):
    return views.historical_features(day_labels(spark, d), day_features(spark, d), DAY_VIEW, "label_time")


def historical_features_left(spark, d):
    return views.historical_features(day_labels(spark, d), day_features(spark, d), DAY_VIEW, "label_time", "left")


def feature_export(spark, d):
    """Today's snapshot and an older one in one table: the newest row per customer is exported."""
    today = features_90d(spark, d)
    older = today.withColumn("event_timestamp", F.col("event_timestamp") - F.expr("INTERVAL 1 DAY"))
    older = older.withColumn("f_total_orders_90d", F.col("f_total_orders_90d") + 100)
    return views.export_features(older.unionByName(today), ["customer_id"])


def materialize_latest(spark, d):
    return views.materialize(day_features(spark, d), DAY_VIEW, START, END)


def online_lookup(spark, d):
    wanted = raw.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return views.online_lookup(materialize_latest(spark, d), wanted, DAY_VIEW)


def online_refresh(spark, d):
    """Two materialisations one after the other: the later rows win."""
    feats = day_features(spark, d)
    first = views.materialize(feats, DAY_VIEW, "2024-01-01", START)
    return views.refresh_online(first, views.materialize(feats, DAY_VIEW, START, END), DAY_VIEW)


def rolling_60m(spark, d):
    return rolling_count(raw.table(spark, d, "events"), "user_id", "ts", 60, "events_60m")


_ASOF = """
    SELECT l.event_id, l.user_id, l.label_time, {cols}
    FROM day_labels l {kind} JOIN day_features f ON l.user_id = f.user_id AND l.label_time >= f.event_timestamp"""
_FRESH = "f.event_timestamp >= l.label_time - INTERVAL 10 DAY"
_LATEST = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, created_timestamp DESC) AS rn
        FROM day_features WHERE event_timestamp BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}')
    WHERE rn = 1"""

QUERIES = {
    "customer_90d_line": (customer_90d_line, customer_90d("line")),
    "customer_90d_order": (customer_90d_order, customer_90d("order")),
    "historical_features": (
        historical_features,
        _ASOF.format(cols="f.event_timestamp AS feature_time, f.f_events, f.f_value", kind="ASOF") + f" WHERE {_FRESH}",
    ),
    "historical_features_left": (
        historical_features_left,
        _ASOF.format(
            cols=f"""CASE WHEN {_FRESH} THEN f.event_timestamp END AS feature_time,
                     CASE WHEN {_FRESH} THEN f.f_events END AS f_events,
                     CASE WHEN {_FRESH} THEN f.f_value END AS f_value""",
            kind="ASOF LEFT",
        ),
    ),
    "feature_export": (
        feature_export,
        f"SELECT *, event_timestamp AS created_timestamp FROM ({customer_90d('line')})",
    ),
    "materialize_latest": (materialize_latest, _LATEST.format(lo=START, hi=END)),
    "online_lookup": (
        online_lookup,
        f"""
        SELECT c.c_custkey AS user_id, f.f_events, f.f_value
        FROM customer c LEFT JOIN ({_LATEST.format(lo=START, hi=END)}) f ON c.c_custkey = f.user_id""",
    ),
    "online_refresh": (online_refresh, _LATEST.format(lo="2024-01-01", hi=END)),
    "rolling_60m": (
        rolling_60m,
        """
        SELECT user_id, ts, rows_at_time,
               CAST(sum(rows_at_time) OVER (PARTITION BY user_id ORDER BY ts
                    RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS BIGINT) AS events_60m
        FROM (SELECT user_id, ts, count(*) AS rows_at_time FROM events GROUP BY user_id, ts)""",
    ),
}
