"""Burst flags and unmatched rows of streams, over several micro-batches and a restart."""

import datetime as dt
import random
from collections import Counter

from lakeloom.streaming.bursts import burst_windows
from lakeloom.streaming.ingest import append_to_table
from lakeloom.streaming.stateful import unmatched_stream
from pyspark.sql import functions as F

T0 = dt.datetime(2025, 1, 1)
EVENTS = "who string, at timestamp, kind string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def bursts(spark, path):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
    counts = {"views": F.col("kind") == "view", "carts": F.col("kind") == "cart"}
    return burst_windows(stream, ["who"], "at", counts, minutes=10, trailing=3, factor=2.0, least=3, lateness="5 minutes")


def test_bursts_over_batches_and_a_restart(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rng = random.Random(2)
    rows = [
        (rng.choice(["a"] * 6 + ["b", None]), T0 + dt.timedelta(minutes=rng.choice([rng.randint(0, 239), rng.randint(100, 109)])), rng.choice(["view", "view", "cart"]))
        for _ in range(500)
    ]
    rows.sort(key=lambda r: r[1])
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(3):
        put(spark, rows[k * 100 : (k + 1) * 100], EVENTS, path)
    append_to_table(bursts(spark, path), out, state).awaitTermination()
    early = spark.read.parquet(out).count()
    for part in (rows[300:400], rows[400:], [("end", T0 + dt.timedelta(days=9), "view")]):
        put(spark, part, EVENTS, path)
    append_to_table(bursts(spark, path), out, state).awaitTermination()

    views, carts = Counter(), Counter()
    for who, at, kind in rows:
        start = at.replace(minute=at.minute // 10 * 10)
        (views if kind == "view" else carts)[who, start] += 1
    want = []
    for who, start in {*views, *carts}:
        if who is None:
            continue
        n, before = views[who, start], sum(views[who, start - dt.timedelta(minutes=10 * k)] for k in (1, 2, 3))
        want.append((who, start, n, carts[who, start], before / 3, n >= 3 and n * 3 >= 2 * before))
    got = [tuple(r) for r in spark.read.parquet(out).filter("who <> 'end'").withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()]
    assert 0 < early < len(got) and sorted(got) == sorted(want) and any(w[5] for w in want)


def test_bursts_are_one_aggregation(spark, tmp_path):
    """A batch frame gives all windows, and no row goes through Python."""
    rows = [("a", T0 + dt.timedelta(minutes=m), k) for m, k in ((0, "view"), (9, "view"), (12, "cart"), (31, "view"), (32, "view"), (33, "view"), (75, "view"))]
    df = spark.createDataFrame([*rows, (None, T0, "view"), ("a", None, "view"), ("b", T0, None)], EVENTS)
    counts = {"views": F.col("kind") == "view", "carts": F.col("kind") == "cart"}
    found = burst_windows(df, ["who"], "at", counts, minutes=10, trailing=3, factor=2.0, least=3)
    at = lambda m: T0 + dt.timedelta(minutes=m)
    want = {("a", at(0), 2, 0, 0.0, False), ("a", at(10), 0, 1, 2 / 3, False), ("a", at(30), 3, 0, 2 / 3, True), ("a", at(70), 1, 0, 0.0, False), ("b", at(0), 0, 0, 0.0, False)}
    got = found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "TransformWithState" not in plan


def test_unmatched_rows_once_and_hot_key(spark, tmp_path):
    rng = random.Random(3)
    orders = [(i, "hot" if i % 3 else f"k{i % 7}", T0 + dt.timedelta(seconds=i * 20)) for i in range(400)]
    paid = [(k, at + dt.timedelta(seconds=rng.randint(-30, 900))) for i, k, at in orders if rng.random() < 0.05]
    kinds = {"orders": "i int, k string, at timestamp", "paid": "k string, paid_at timestamp"}
    far = T0 + dt.timedelta(days=30)
    for name, rows, last in (("orders", orders, (-1, "end", far)), ("paid", sorted(paid, key=lambda r: r[1]), ("end", far))):
        step = -(-len(rows) // 4)
        for k in range(4):
            put(spark, rows[k * step : (k + 1) * step], kinds[name], str(tmp_path / name))
        put(spark, [last], kinds[name], str(tmp_path / name))
    sides = {n: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n)) for n, s in kinds.items()}
    found = unmatched_stream(sides["orders"], sides["paid"], ["k"], "at", "paid_at", "0 seconds", "10 minutes", "3 hours", bucket=120)
    append_to_table(found, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    limit = dt.timedelta(minutes=10)
    want = sorted(i for i, k, at in orders if not any(k == x and at <= t <= at + limit for x, t in paid))
    got = sorted(r.i for r in spark.read.parquet(str(tmp_path / "out")).filter("i >= 0").collect())
    assert got == want and 0 < len(want) < len(orders)
