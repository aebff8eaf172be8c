import datetime as dt
import itertools

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators.ordering import (
    dense_key,
    extend_keys,
    ordered_slices,
    quantiles,
    rolling_count,
    running_max,
    running_sum,
    write_order,
)


def scrambled(spark, n=20_000):
    return spark.range(n, numPartitions=7).select(((F.col("id") * 7919) % n).alias("k"), F.col("id").alias("v"))


def test_dense_key_equals_a_global_row_number(spark):
    df = scrambled(spark).filter("k % 3 != 0").withColumn("s", F.concat(F.lit("c"), "k"))
    got = dense_key(df, "s", "key", start=5)
    want = df.withColumn("want", F.row_number().over(Window.orderBy("s")) + 4)
    assert got.join(want, "s").filter("key != want").count() == 0
    assert got.count() == df.count() and got.columns == ["key", "k", "v", "s"]


def test_dense_key_by_two_columns(spark, rows):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (1, "a")], "t int, s string")
    assert rows(dense_key(df, ["t", "s"], "key")) == [(1, 1, "a"), (2, 1, "b"), (3, 2, "a")]


def test_no_big_side_in_one_task(spark):
    """Only the one-row-per-slice frame goes through a single partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordered_slices(scrambled(spark), ["k"])
        sizes = [r.n for r in placed.groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    plan = dense_key(scrambled(spark), "k", "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1


def test_keys_stay_when_ids_arrive(spark, rows):
    first = dense_key(spark.createDataFrame([("a",), ("c",)], "id string"), "id", "key")
    now = spark.createDataFrame([("a",), ("b",), ("c",), ("0",)], "id string")
    assert rows(extend_keys(now, first, "id", "key")) == [(1, "a"), (2, "c"), (3, "0"), (4, "b")]
    none_yet = spark.createDataFrame([], "key bigint, id string")
    assert rows(extend_keys(now, none_yet, "id", "key").select("id", "key")) == [("0", 1), ("a", 2), ("b", 3), ("c", 4)]


def test_running_max_equals_a_global_window(spark):
    df = scrambled(spark).select("k", ((F.col("v") * 31) % 1009).alias("v"))
    got = running_max(df, "v", ["k"], "seen")
    want = df.withColumn("want", F.max("v").over(Window.orderBy("k")))
    assert got.join(want, "k").filter("seen != want").count() == 0 and got.count() == 20_000


def test_write_order_is_global(spark, tmp_path):
    path = str(tmp_path / "sorted")
    write_order(scrambled(spark), ["k"]).select(F.col("k").cast("string")).write.text(path)
    files = sorted((tmp_path / "sorted").glob("part-*"))
    lines = list(itertools.chain.from_iterable(f.read_text().split() for f in files))
    assert [int(x) for x in lines] == list(range(20_000))


@pytest.mark.parametrize("minutes", [30, 60, 90])
def test_rolling_count_against_brute_force(spark, minutes):
    base = dt.datetime(2025, 1, 1)
    data = [("hot" if i % 3 else f"u{i % 7}", base + dt.timedelta(seconds=(i * 7919) % 90_000)) for i in range(400)]
    data += data[:40] + [(None, base)]
    df = spark.createDataFrame(data, "u string, t timestamp_ntz")
    span = dt.timedelta(minutes=minutes)
    for r in rolling_count(df, "u", "t", minutes, "n").collect():
        assert r.n == sum(1 for u, t in data if u == r.u and r.t - span <= t <= r.t)
        assert r.rows_at_time == sum(1 for u, t in data if u == r.u and t == r.t)


def test_a_value_with_most_rows_spans_slices(spark):
    df = spark.range(16_000, numPartitions=8).select(F.lit(1).alias("k"), F.lit(2).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordered_slices(df, ["k"])
        assert placed.select("_slice").distinct().count() > 4
        assert running_max(df, "v", ["k"], "seen").filter("seen = 2").count() == 16_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_sum_and_exact_quantiles(spark, rows):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("v"))
    got = running_sum(df, "v", ["id"], "s")
    want = df.withColumn("want", F.sum("v").over(Window.orderBy("id")))
    assert got.join(want, "id").filter("s != want").count() == 0
    data = [(float(x),) for x in [1, 1, 1, 2, 3, 4, 5, 6, 7, 8]] + [(None,)]
    cuts = quantiles(spark.createDataFrame(data, "v double"), "v", [0.1, 0.3, 0.31, 0.5, 1.0]).first().cuts
    assert cuts == [1.0, 1.0, 2.0, 3.0, 8.0]
