import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.joins import (
    all_whole,
    hot_keys,
    keys_without_rows,
    lookup,
    order_totals,
    orphans,
    small_ones,
    spread_join,
    star_join,
    unmatched,
    zero_filled_totals,
)


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows on key 7, a third on NULL, the rest scattered; some keys unknown."""
    return spark.range(30_000, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id") % 6000).cast("bigint").alias("k"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def test_hot_keys_and_null_share_are_found(fact, spark):
    (hot,) = hot_keys(fact, [["k"]])
    seven = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert set(hot) == {seven, None}
    assert hot[seven] == 3 and hot[None] == 3  # a third of 8 shuffle partitions, rounded up


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_spread_join_equals_the_plain_join(fact, dim, rows, how, limit):
    plain = fact.join(dim, "k", how).select("id", "k", "name")
    got = spread_join(fact, dim, ["k"], how, limit=limit)
    assert got.columns == ["id", "k", "name"]
    assert rows(got) == rows(plain)


def test_hot_key_is_spread_over_tasks(fact, dim, spark):
    """Rows of the hot key and of NULL end in several shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = spread_join(fact, dim, ["k"], "left", limit=0).withColumn("p", F.spark_partition_id())
        per_key = {r.k: r.n for r in got.groupBy("k").agg(F.countDistinct("p").alias("n")).filter("k = 7 OR k IS NULL").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert per_key[7] > 1 and per_key[None] > 1


def test_no_salt_without_hot_keys(dim, spark):
    even = spark.range(20_000).select(F.col("id"), (F.col("id") % 5000).alias("k"))
    plan = spread_join(even, dim, ["k"], limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan


def test_composite_keys(spark, rows):
    left = spark.range(3000).selectExpr("id", "IF(id % 2 = 0, 1, id) AS a", "IF(id % 2 = 0, 'x', NULL) AS b")
    right = spark.createDataFrame([(1, "x", 10), (3, "y", 20)], "a bigint, b string, v int")
    assert rows(spread_join(left, right, ["a", "b"], limit=0)) == rows(
        left.join(right, ["a", "b"], "left").select("id", "a", "b", "v")
    )


def test_star_join_keeps_rows_and_looks_up_all(fact, dim, rows):
    other = dim.select(F.col("id") if "id" in dim.columns else F.col("k").alias("id"), F.col("name").alias("other"))
    for limit in (0, 10**9):
        got = star_join(fact, [(dim, "k", ["name"]), (other, "id", ["other"])], limit=limit)
        assert got.count() == fact.count()
        assert got.filter("id < 5000 AND other != concat('n', id)").count() == 0
    assert rows(lookup(fact, dim, "k", ["name"]).filter("k = 7").select("name").distinct()) == [("n7",)]


def test_sizes_are_measured(spark):
    wide = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert small_ones([wide, spark.range(10)], limit=50_000) == [False, True]
    assert small_ones([]) == []


def test_totals_of_whole_cents_are_those_of_decimals(spark, rows):
    rng = random.Random(5)
    cents = [rng.choice([1, 10, 10**4, 10**9]) * rng.randint(-9, 9) // rng.randint(1, 9) for _ in range(3000)]
    lines = [(i % 700, c / 100) for i, c in enumerate(cents) if abs(c) <= 10**9] + [(1, None), (9999, None), (None, 0.05), (9998, -0.04)]
    items = spark.createDataFrame(lines, "o long, v double")
    assert all_whole(items, "v") and all_whole(items.filter("false"), "v")
    for places in (0, 1, 2):
        assert rows(order_totals(items, "o", "v", places, whole=True)) == rows(order_totals(items, "o", "v", places))
    for odd in (0.004, 1e7 + 0.01, 1e300, 0.1 + 0.2, float("nan"), float("inf"), float("-inf")):
        assert not all_whole(items.limit(1).union(spark.createDataFrame([(1, odd)], "o long, v double")), "v"), odd
    assert not all_whole(items.selectExpr("o", "CAST(v AS DECIMAL(20,2)) AS v"), "v")


def test_order_totals(spark, rows):
    items = spark.createDataFrame([("a", 1.15), ("a", 2.1), ("b", 0.05)], "o string, v double")
    assert rows(order_totals(items, "o", "v")) == [("a", 2, 3.3), ("b", 1, 0.1)]
    base = spark.createDataFrame([("a",), ("c",)], "o string")
    assert rows(zero_filled_totals(base, items, "o", "v", "due")) == [("a", 3.3), ("c", 0.0)]


def test_guest_orders_are_no_orphans(spark, rows):
    source = spark.createDataFrame([(1, "c1"), (2, None), (3, "gone")], "o int, c string")
    fact = spark.createDataFrame([(1, 10), (2, None), (3, None)], "o int, ck int")
    assert rows(orphans(fact, source, "o", "ck", "c")) == [(3, None)]
    dim = spark.createDataFrame([("c1",)], "c string")
    assert rows(unmatched(source, dim, "c")) == [("gone", 3)]


def test_set_difference(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(keys_without_rows(a, b, "k")) == [(None,), (1,)]


def test_exact_copies_of_a_row_are_spread(dim, spark, rows):
    copies = spark.range(8000, numPartitions=8).select(F.lit(7).cast("bigint").alias("k"), F.lit("same").alias("s"))
    left = copies.unionByName(spark.range(4000).select(F.col("id").alias("k"), F.lit("one").alias("s")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = spread_join(left, dim, ["k"], "inner", limit=0)
        tasks = got.filter("s = 'same'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks > 1
    assert got.count() == 12_000 and got.filter("name != concat('n', k)").count() == 0


@pytest.mark.parametrize(("a", "b"), [("int", "bigint"), ("bigint", "int"), ("bigint", "bigint")])
def test_keys_of_different_width_still_match_when_salted(spark, a, b):
    left = spark.range(9000).selectExpr(f"CAST(IF(id % 3 = 0, 7, id) AS {a}) AS k", "id")
    right = spark.range(9000).selectExpr(f"CAST(id AS {b}) AS k", "id AS v")
    if b == "bigint":
        right = right.unionByName(spark.range(1).selectExpr(f"CAST(9000000000 AS {b}) AS k", "id AS v"))
    got = spread_join(left, right, ["k"], "inner", limit=0)
    assert got.count() == 9000 and got.filter("k != v").count() == 0
