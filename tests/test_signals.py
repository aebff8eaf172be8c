"""Carried state, n-way merge as of a time, rolling sums, sketches and money of any size."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest

from lakeloom.functions import cents, exact, exact_sum, exact_type, mean_half_up
from lakeloom.operators.asof import Timeline, merge_as_of
from lakeloom.operators.joins import order_totals
from lakeloom.operators.ordering import keyed_running, rolling_sums
from lakeloom.operators.sketches import hour_table, rank_bounds, rolled_up
from pyspark.sql import functions as F

T0 = dt.datetime(2025, 1, 1)


def test_carried_state_over_slices(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i, rng.choice([None, rng.randint(0, 9)]), rng.randint(-3, 3)) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t int, v int, n long").repartition(7)
    got = {(r.k, r.t): (r.v, r.n) for r in keyed_running(df, ["k"], ["t"], last=["v"], sums=["n"]).collect()}
    state = {}
    for k, t, v, n in sorted(rows, key=lambda r: r[1]):
        old = state.get(k, (None, 0))
        state[k] = (old[0] if v is None else v, old[1] + n)
        assert got[k, t] == state[k]


@pytest.mark.parametrize("closed", ["right", "both"])
def test_rolling_sums_against_brute_force(spark, closed):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "x", None]), T0 + dt.timedelta(hours=rng.choice([rng.randint(0, 300), 24 * rng.randint(0, 9)])), rng.randint(0, 5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v long")
    found = rolling_sums(df, ["k"], "t", "2 days", {"n": F.count(F.lit(1)), "s": F.sum("v")}, closed)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    span = dt.timedelta(days=2)
    for r in found.collect():
        inside = [v for k, t, v in rows if k == r.k and (r.t - span < t <= r.t or closed == "both" and t == r.t - span)]
        assert (r.n, r.s) == (len(inside), sum(inside))
        assert r.n_at_time == sum(k == r.k and t == r.t for k, t, _ in rows)


def test_merge_of_three_timelines(spark):
    rng = random.Random(3)
    at = lambda: T0 + dt.timedelta(minutes=rng.randint(0, 5000))
    who = lambda: rng.choice(["hot", "hot", "a", "b", None])
    labels = [(i, who(), rng.choice([at(), at(), None])) for i in range(300)]
    tables = [[(who(), at(), at(), i * 10 + j) for i in range(400)] for j in range(3)]
    ttls = ["12 hours", None, "30 minutes"]
    lines = [
        Timeline(spark.createDataFrame(t, f"c string, at timestamp_ntz, made timestamp_ntz, f{j} int"), "at", "made", ttls[j], seen=f"t{j}")
        for j, t in enumerate(tables)
    ]
    df = spark.createDataFrame(labels, "i int, c string, lt timestamp_ntz")
    got = {r.i: r for r in merge_as_of(df, lines, ["c"], "lt").collect()}
    limits = [dt.timedelta(hours=12), dt.timedelta(days=999), dt.timedelta(minutes=30)]
    assert len(got) == len(labels)
    for i, c, lt in labels:
        for j, (table, limit) in enumerate(zip(tables, limits)):
            known = [(t, made, f) for k, t, made, f in table if c is not None and lt is not None and k == c and t <= lt]
            best = max(known) if known else None
            want = (best[0], best[2]) if best and best[0] >= lt - limit else (None, None)
            assert (got[i][f"t{j}"], got[i][f"f{j}"]) == want


def test_merge_splits_one_entity_within_one_hour(spark):
    """All rows of one entity in one hour: no task holds more than a few slices of them."""
    n = 200_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    feats = spark.range(n).select(F.lit("hot").alias("c"), F.timestamp_micros(F.col("id") * 17_000).alias("at"), F.col("id").alias("f"))
    labels = spark.range(1000).select(F.lit("hot").alias("c"), F.timestamp_micros(F.col("id") * 3_400_000 + 5).alias("lt"))
    found = merge_as_of(labels, [Timeline(feats, "at")], ["c"], "lt")
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 900
    assert found.filter(F.col("f") != F.floor((F.unix_micros("lt")) / 17_000)).count() == 0


def test_columns_that_clash_are_refused(spark):
    df = spark.createDataFrame([("a", T0, 1)], "c string, at timestamp_ntz, f int")
    with pytest.raises(ValueError):
        merge_as_of(df.withColumnRenamed("at", "lt"), [Timeline(df, "at")], ["c"], "lt")


def test_day_sketches_from_hours_alone(spark):
    rng = random.Random(5)
    values = [rng.lognormvariate(3, 1) for _ in range(30_000)]
    rows = [("s", T0 + dt.timedelta(seconds=i * 2), v) for i, v in enumerate(values)] + [("s", T0, float("nan")), ("s", T0, None), ("quiet", T0, None)]
    df = spark.createDataFrame(rows, "s string, t timestamp, v double")
    hours = hour_table(df, "t", "v", ["s"], F.col("v") > 100).checkpoint()
    days = rolled_up(hours, ["s"], {"p5": 0.05, "p50": 0.5, "p95": 0.95}).collect()
    quiet, day = sorted(days, key=lambda r: r.requests)[0], sorted(days, key=lambda r: r.requests)[-1]
    assert (quiet.p95, quiet.requests, quiet.errors) == (None, 1, 0) and hours.count() == 18
    assert day.requests == 30_002 and day.errors == sum(v > 100 for v in values) + 1  # NaN is above all
    for mark, share in (("p5", 0.05), ("p50", 0.5), ("p95", 0.95)):
        assert abs(sum(v <= day[mark] for v in values) / len(values) - share) < 0.02
    bounds = rank_bounds(df.filter("v < 1e9").withColumn("cut", F.lit(day.p50)), "v", "cut", ["s"]).first()
    assert abs(bounds.rank_high - 0.5) < 0.02 and bounds.rank_low <= bounds.rank_high


# --- money ---------------------------------------------------------------------------------


def total(spark, values, kind="double", places=2):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return df.select(exact_sum("v", places, exact_type(df, "v"))).first()[0]


def test_small_amounts_are_not_cut(spark):
    assert spark.range(1_000_000).select(exact_sum(F.lit(4e-7), 1)).first()[0] == 0.4
    assert total(spark, [1e-9] * 1000, places=9) == 1e-6


def test_large_amounts_do_not_saturate(spark):
    assert total(spark, [1e13, 1.0]) == 1e13 + 1
    assert total(spark, [Decimal("12345678901234567.89")], "decimal(38,2)") == 12345678901234567.89
    assert total(spark, [Decimal("9" * 35)], "decimal(38,0)", 0) == 1e35
    with pytest.raises(Exception, match="(?i)overflow|out_of_range|cannot be represented"):
        total(spark, [1e30])


def test_nan_and_infinity(spark):
    inf = float("inf")
    assert math.isnan(total(spark, [1.0, float("nan")])) and math.isnan(total(spark, [inf, -inf]))
    assert total(spark, [1.0, inf, None]) == inf and total(spark, [-inf, 5.0]) == -inf
    assert total(spark, [None, None]) is None
    for bad in (float("nan"), inf):
        for of in (exact, cents):
            with pytest.raises(Exception, match="not an amount"):
                spark.createDataFrame([(bad,)], "v double").select(of("v")).collect()
    with pytest.raises(Exception, match="not an amount"):
        spark.range(1).select(cents(F.lit(1e17))).collect()


def test_totals_keep_the_column_type(spark):
    df = spark.createDataFrame([(1, Decimal("12345678901234567.89")), (1, Decimal("0.01"))], "k int, v decimal(38,2)")
    assert order_totals(df, "k", "v", 2).first().order_net_amount == 12345678901234567.90


def test_mean_of_wide_totals(spark):
    df = spark.createDataFrame([(Decimal(10**30 + 5), 2), (Decimal(-15), 10), (Decimal(5), 0)], "t decimal(38,0), n long")
    got = [r[0] for r in df.select(mean_half_up("t", "n", 1, 2)).collect()]
    assert got[0] == (10**30 + 5) / 2 / 100 and got[1] == -0.0 and got[2] is None
