import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators import inject
from lakeloom.operators.aggregates import dup_rate, rate, row_counts, share_of_top, top_k
from lakeloom.operators.drift import psi
from lakeloom.plans import checks, profile
from lakeloom.queries.quality import reproducible

T0 = dt.datetime(2025, 1, 1)


def result(df):
    return [(r["check"], r["passed"], r["detail"]) for r in df.collect()]


def test_checks_pass_and_fail(spark):
    good = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    bad = spark.createDataFrame([(1, 1.0), (1, None), (None, 20.0)], "k int, v double")
    assert result(checks.unique(good, "k", "u")) == [("u", True, "2 rows, 2 distinct")]
    assert result(checks.unique(bad, "k", "u")) == [("u", False, "3 rows, 1 distinct")]
    assert result(checks.required(bad, ["k", "v"], "r")) == [("r", False, "2 nulls")]
    assert result(checks.null_split(bad, "v", "s")) == [("s", True, "null=1 not_null=2")]
    assert result(checks.reconcile(good, "v", bad, "v", "m")) == [("m", False, "left=3 right=21")]
    assert result(checks.reconcile(good, "v", bad, "v", "m", tolerance=19)) == [("m", True, "left=3 right=21")]
    empty = good.filter("false")
    assert result(checks.reconcile(empty, "v", empty, "v", "m")) == [("m", True, "left=0 right=0")]


def test_rules_over_rows(spark):
    df = spark.createDataFrame([(T0, T0, None, None), (T0, T0 - dt.timedelta(1), None, "gold")], "t timestamp_ntz, c timestamp_ntz, ch string, tier string")
    assert result(checks.clocks_in_order(df, "t", "c", "clock")) == [("clock", False, "1 violations")]
    assert result(checks.implies_null(df, "ch", "tier", "null")) == [("null", False, "1 violations")]
    assert result(checks.within(df, rate(F.col("tier").isNull()), 0.5, 0.01, "w")) == [("w", True, "rate=0.5000")]
    assert result(checks.above(df, rate(F.col("tier").isNull()), 0.5, "a")) == [("a", False, "rate=0.5000")]
    assert result(checks.has_columns(df, ["t", "x"], "cols")) == [("cols", False, "missing: x")]
    assert result(checks.has_columns(df, ["t"], "cols")) == [("cols", True, "all present")]


def test_same_rows_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "b")], "k int, s string")
    assert result(checks.same_rows(a, a.repartition(3), "s")) == [("s", True, "0 differing rows")]
    assert result(checks.same_rows(a, a.distinct(), "s")) == [("s", False, "1 differing rows")]


def test_rates_and_rankings(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 3), (None, 3)], "k string, v int")
    assert df.agg(dup_rate("k")).first()[0] == 0.5
    assert share_of_top(df, "k", 1).first().share == 0.5
    assert [r.v for r in top_k(df, "v", 2, ["k"]).collect()] == [3, 3]
    assert [r.k for r in top_k(df, "v", 2, ["k"]).collect()] == [None, "a"]
    assert rows(row_counts({"x": df, "y": df.limit(1)})) == [("x", 4), ("y", 1)]


def test_top_k_keeps_k_rows_per_task(spark):
    plan = top_k(spark.range(1000), "id", 5, [])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_out_of_order_equals_a_global_window(spark):
    df = spark.range(5000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz").alias("t"))
    df = inject.inject_copies(inject.inject_late(df, "event_id", "t", "c"), "event_id", 67)
    order = Window.orderBy("c", "event_id", "t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("top", F.max("t").over(order)).filter("t < top").count()
    got = profile.out_of_order(df, "event_id", "t", "c").filter("late_in_order").agg(F.sum("copies")).first()[0]
    assert got == want > 100


def test_stream_profile_meets_the_injected_rates(spark):
    df = spark.range(10_000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("event_timestamp"),
        F.when(F.col("id") % 5 >= 2, F.col("id")).alias("customer_id"),
    )
    df = inject.inject_copies(inject.inject_late(df, "event_id", "event_timestamp", "created_ts"), "event_id", 67)
    got = {r.metric: r.measured for r in profile.stream_profile(df, ["07:00-09:00"]).collect()}
    assert got["total_events"] == df.count()
    assert abs(got["late_share"] - 0.12) < 0.01 and abs(got["duplicate_rate"] - 0.015) < 0.002
    assert abs(got["anonymous_rate"] - 0.4) < 0.01 and abs(got["burst_share"] - 2 / 24) < 0.02


def test_faults_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(500).withColumn("v", F.col("id"))
    def hit(x):
        return inject.inject_nulls(inject.inject_copies(x, "id", 50), "id", "v", 7, rest=(0, 3))
    assert rows(hit(df)) == rows(hit(df.repartition(5)))
    assert hit(df).count() == 510 and hit(df).filter("v IS NULL AND id % 7 NOT IN (0, 3)").count() == 0
    skew = spark.range(10_000).select(inject.inject_skew("id", 75, 8, 1000).alias("s"))
    assert skew.filter("s < 8").count() / 10_000 == pytest.approx(0.75, abs=0.01)
    burst = spark.range(3200).select(inject.inject_burst("id", [7, 8], [3, 1]).alias("h"))
    assert burst.filter("h = 7").count() == 2400


def test_psi(spark):
    base = spark.range(10_000).select(F.col("id").cast("double").alias("v"))
    same = psi(base, base, "v").collect()
    assert len(same) == 10 and same[0].psi == 0 and not same[0].drifted
    assert sum(r.base_rows for r in same) == 10_000
    moved = psi(base, base.filter("v > 5000"), "v").first()
    assert moved.psi > 1 and moved.drifted
    assert not psi(base, base.filter("v > 5000"), "v", alert=100).first().drifted
    sketched = psi(base, base.filter("v > 5000"), "v", exact=False).first()
    assert sketched.psi == pytest.approx(moved.psi, rel=0.05)


def test_reproducible_has_no_fixed_number_of_tasks(spark, tmp_path):
    rows = [(i // 3, i % 3 + 1, i % 7, 1.5 * i, 0.1, float(i % 5), dt.datetime(2025, 1, 1 + i % 9)) for i in [*range(300), *range(50)]]
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double, l_discount double, l_quantity double, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = reproducible(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" not in found._jdf.queryExecution().toString()
    row = found.first()
    assert row.passed and row.rows == 300
