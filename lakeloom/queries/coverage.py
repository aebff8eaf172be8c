"""Operators that no other query reaches: fine amounts, missing columns, empty days, catalog tables, sections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators.aggregates import dup_rate, rate
from ..operators.history import upsert
from ..operators.joins import star_join, unmatched
from ..plans import gold
from ..plans.checks import has_columns, run_checks
from ..plans.layers import clean_items, clean_orders
from ..plans.profile import daily_health
from ..plans.runner import lineage, retail_stages
from ..session import scratch
from ..sources.readers import optional_table, register_views, union_by_name
from ..sources.writers import create_namespace, drop_table, save_table, staged, write_section, write_table
from . import raw
from .sql import customer_90d


def fine_amounts(spark, d):
    """Charged amounts with up to six decimals, summed as they are and rounded once."""
    charged = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = raw.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", charged.alias("charged"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(exact_sum("charged", 2).alias("charged"))


def unmatched_refs(spark, d):
    """Orders that name a customer outside the segment BUILDING."""
    orders = raw.table(spark, d, "orders").select("o_custkey", "o_orderkey")
    known = raw.table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    return unmatched(orders, known.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")


def columns_present(spark, d):
    """Required columns, next to the rows that have them."""
    events = raw.table(spark, d, "events")
    checks = run_checks(
        [
            has_columns(events, ["event_id", "ts", "user_id"], "events keys"),
            has_columns(events, ["event_id", "session_id"], "events session"),
        ]
    )
    return checks.withColumn("rows", events.agg(F.count(F.lit(1))).scalar())


def union_missing_columns(spark, d):
    """Orders before and after a column came into being, counted by it."""
    orders = raw.table(spark, d, "orders")
    early = orders.filter("o_orderdate < '1998-01-01'").drop("o_orderpriority")
    late = orders.filter("o_orderdate >= '1998-01-01'")
    both = union_by_name([early, late])
    return both.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice", 2).alias("total"))


def profile_empty_day(spark, d):
    """Rates of a day without events next to those of all days."""
    events = raw.table(spark, d, "events")
    frames = {"all": events, "none": events.filter("ts < '1990-01-01'")}
    parts = [
        df.agg(
            F.lit(name).alias("day"), F.count(F.lit(1)).alias("events"),
            rate(F.col("event_type") == "purchase").alias("purchase_rate"), dup_rate("user_id").alias("dup_rate"),
        )
        for name, df in frames.items()
    ]
    return parts[0].unionByName(parts[1])


def customer_90d_null_amounts(spark, d):
    """Orders with a line whose amount is not known."""
    items = clean_items(raw.raw_items(spark, d))
    unknown = F.col("order_id") % 7 == 0
    items = items.withColumn("line_amount", F.when(~unknown, F.col("line_amount")))
    return gold.customer_features(clean_orders(raw.raw_orders(spark, d)), staged(items, "items"), raw.raw_products(spark, d), grain="order")


def vector_lookup(spark, d):
    """A wide side of vectors joined to events: measured by its real size."""
    events = raw.table(spark, d, "events").select("event_id", (F.col("user_id") % 500).alias("vec_id"))
    vectors = raw.table(spark, d, "embeddings").select("vec_id", "embedding", "label").dropDuplicates(["vec_id"])
    found = star_join(events, [(vectors, "vec_id", ["embedding", "label"])])
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("events"), F.sum(F.size("embedding")).alias("components"))


def catalog_roundtrip(spark, d):
    """Create, append to and read a catalog table; a table that is not there is None."""
    space = f"lake_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, space)
    nation = raw.table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    save_table(nation, f"{space}.nation")
    save_table(nation.filter("n_regionkey = 0"), f"{space}.nation", mode="append")
    missing = optional_table(spark, f"{space}.absent") is None
    out = optional_table(spark, f"{space}.nation").groupBy("n_regionkey").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_nationkey").alias("keys")
    )
    result = staged(out.withColumn("absent", F.lit(missing)), "catalog")
    drop_table(spark, f"{space}.nation")
    spark.sql(f"DROP DATABASE {space}")
    return result


def append_counts(spark, d):
    """Rows after an overwrite and two appends."""
    path = scratch(spark, "appended")
    parts = raw.table(spark, d, "part").select("p_partkey", "p_size")
    counts = [write_table(parts, path), write_table(parts.filter("p_size > 25"), path, "append"), write_table(parts.filter("p_size <= 5"), path, "append")]
    total = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.sum("p_partkey").alias("keys"))
    return total.select("rows", "keys", F.lit(sum(counts)).cast("bigint").alias("counted"))


def report_sections(spark, d):
    """One section of a report replaced, the other kept."""
    path = scratch(spark, "report")
    orders, items = raw.table(spark, d, "orders"), raw.table(spark, d, "lineitem")
    count = lambda df: df.agg(F.lit("rows").alias("metric"), F.count(F.lit(1)).alias("value"))
    write_section(count(orders), path, "orders")
    write_section(count(items.filter("l_linenumber < 0")), path, "items")
    write_section(count(items), path, "items")
    return spark.read.parquet(path).select("section", "metric", "value")


def view_over_glob(spark, d):
    """SQL over views of Parquet globs."""
    names = {f"glob_{n}": f"{d}/{n}.parquet*" for n in ("nation", "region")}
    register_views(spark, names)
    return spark.sql(
        "SELECT r_name, count(*) AS nations FROM glob_nation JOIN glob_region ON n_regionkey = r_regionkey GROUP BY r_name"
    )


def lineage_edges(spark, d):
    """Edges of the layered run, with the rows of each raw source."""
    sources = {"orders": f"{d}/orders.parquet", "customers": f"{d}/customer.parquet"}
    edges = lineage(spark, retail_stages(spark, sources, scratch(spark, "lake"))).filter("stage = 'bronze'")
    rows = union_by_name(
        [spark.read.parquet(p).agg(F.lit(f"source.{n}").alias("source"), F.count(F.lit(1)).alias("rows")) for n, p in sources.items()]
    )
    return edges.toDF("source", "target", "stage").join(rows, "source").select("source", "target", "stage", "rows")


def merge_by_event_time(spark, d):
    """Incremental merge by (entity, event time): the later version of a pair wins, new pairs come in."""
    events = raw.table(spark, d, "events")
    purchases = events.filter("event_type = 'purchase'")
    events = events.select("user_id", "ts", "event_id", "value")
    changes = purchases.select("user_id", "ts", (F.col("event_id") + 1_000_000).alias("event_id"), "value")
    merged = upsert(events, changes, ["user_id", "ts"], ["event_id"])
    return merged.groupBy("user_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum("event_id").alias("ids"))


def freshness_and_volume(spark, d):
    """Per day: hours from the day's last event to midnight, and whether volume leaves the mean by three deviations."""
    return daily_health(raw.table(spark, d, "events"), "ts")


QUERIES = {
    "fine_amounts": (
        fine_amounts,
        """SELECT l_returnflag, l_linestatus, round(fsum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS charged
           FROM lineitem GROUP BY ALL""",
    ),
    "unmatched_refs": (
        unmatched_refs,
        """SELECT o_custkey, o_orderkey FROM orders
           WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    ),
    "columns_present": (
        columns_present,
        """SELECT name AS "check", len(missing) = 0 AS passed,
                  CASE WHEN len(missing) = 0 THEN 'all present' ELSE 'missing: ' || array_to_string(missing, ', ') END AS detail,
                  (SELECT count(*) FROM events) AS rows
           FROM (SELECT name, list(col ORDER BY col) FILTER (col NOT IN (SELECT column_name FROM information_schema.columns
                            WHERE table_name = 'events')) AS found, coalesce(found, []) AS missing
                 FROM (VALUES ('events keys', 'event_id'), ('events keys', 'ts'), ('events keys', 'user_id'),
                              ('events session', 'event_id'), ('events session', 'session_id')) AS t(name, col)
                 GROUP BY name)""",
    ),
    "union_missing_columns": (
        union_missing_columns,
        """SELECT CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
                  count(*) AS orders, round(fsum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
    ),
    "profile_empty_day": (
        profile_empty_day,
        """SELECT 'all' AS day, count(*) AS events, count_if(event_type = 'purchase') / count(*) AS purchase_rate,
                  (count(*) - count(DISTINCT user_id)) / count(*) AS dup_rate FROM events
           UNION ALL SELECT 'none', 0, NULL, NULL""",
    ),
    "customer_90d_null_amounts": (
        customer_90d_null_amounts,
        customer_90d("order", "CASE WHEN order_id % 7 <> 0 THEN line_amount END"),
    ),
    "vector_lookup": (
        vector_lookup,
        """SELECT label, count(*) AS events, sum(len(embedding))::BIGINT AS components
           FROM events LEFT JOIN embeddings ON vec_id = user_id % 500 GROUP BY label""",
    ),
    "catalog_roundtrip": (
        catalog_roundtrip,
        """SELECT n_regionkey, count(*) AS rows, sum(n_nationkey)::BIGINT AS keys, true AS absent
           FROM (SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey = 0) GROUP BY n_regionkey""",
    ),
    "append_counts": (
        append_counts,
        """SELECT count(*) AS rows, sum(p_partkey)::BIGINT AS keys, count(*) AS counted
           FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_size > 25 UNION ALL SELECT * FROM part WHERE p_size <= 5)""",
    ),
    "report_sections": (
        report_sections,
        """SELECT 'orders' AS section, 'rows' AS metric, count(*) AS value FROM orders
           UNION ALL SELECT 'items', 'rows', count(*) FROM lineitem""",
    ),
    "view_over_glob": (
        view_over_glob,
        "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    ),
    "lineage_edges": (
        lineage_edges,
        """SELECT 'source.' || s AS source, 'bronze.' || t AS target, 'bronze' AS stage, CASE s WHEN 'orders'
                  THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM customer) END AS rows
           FROM (VALUES ('orders'), ('customers')) AS a(s), (VALUES ('orders'), ('customers')) AS b(t)""",
    ),
    "merge_by_event_time": (
        merge_by_event_time,
        """SELECT user_id, count(*) AS pairs, sum(id)::BIGINT AS ids FROM (
               SELECT user_id, ts, max(CASE WHEN event_type = 'purchase' THEN event_id + 1000000 ELSE event_id END) AS id
               FROM events GROUP BY user_id, ts) GROUP BY user_id""",
    ),
    "freshness_and_volume": (
        freshness_and_volume,
        """WITH days AS (SELECT ts::DATE AS day, count(*) AS events, max(ts) AS last FROM events GROUP BY 1)
           SELECT day, events, epoch((day + INTERVAL 1 DAY)::TIMESTAMP) - floor(epoch(last)) > 3600 AS stale,
                  abs(events - (SELECT avg(events) FROM days)) > 3 * (SELECT stddev_pop(events) FROM days) AS odd_volume
           FROM days""",
    ),
}
