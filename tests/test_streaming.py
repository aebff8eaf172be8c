import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.dedup import latest_per_key
from lakeloom.streaming.ingest import append_to_table, file_lines, ingest_events
from lakeloom.streaming.stateful import dedup_stream, epoch_writer, interval_join, split_late, tumbling, upsert_stream

T0 = dt.datetime(2025, 1, 1, 8)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], "event_id long, store string, event_timestamp timestamp_ntz, price double").schema


def put(folder, name, events, extra=()):
    """One file; modification times follow the order of writing."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    lines = [json.dumps({"event_id": i, "store": s, "event_timestamp": t.isoformat(), "price": p}) for i, s, t, p in events]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([*lines, *extra]) + "\n")
    stamp = 1_700_000_000 + len(os.listdir(folder))
    os.utime(path, (stamp, stamp))


FIRST = [(1, "a", minutes(0), 1.0), (2, "a", minutes(30), 2.0), (2, "a", minutes(30), 2.0)]
SECOND = [(3, "b", minutes(130), 4.0), (4, "a", minutes(1), 8.0)]  # the last one is two hours late


def test_raw_capture_keeps_late_rows_and_copies_and_resumes(spark, schema, tmp_path, rows):
    src, out, bad, state = (str(tmp_path / n) for n in ("src", "out", "bad", "state"))

    def run(target=out, checkpoint=state):
        for q in ingest_events(file_lines(spark, src, 1), schema, "event_timestamp", target, checkpoint, quarantine=bad if target == out else None):
            q.awaitTermination()
        return rows(spark.read.parquet(target), "event_id")

    put(src, "1.json", FIRST, ['{"event_id": 9, "sto', "", "  "])
    assert run() == [(1,), (2,), (2,)]
    put(src, "2.json", SECOND)
    assert run() == [(1,), (2,), (2,), (3,), (4,)]  # same checkpoint: only the new file is read
    assert run() == [(1,), (2,), (2,), (3,), (4,)]
    assert rows(spark.read.parquet(bad), "value") == [('{"event_id": 9, "sto',)]
    assert spark.read.parquet(out).filter("ingest_ts IS NULL").count() == 0
    assert run(str(tmp_path / "out2"), str(tmp_path / "state2")) == [(1,), (2,), (2,), (3,), (4,)]  # restart


def run_append(spark, df, tmp_path, name):
    out = str(tmp_path / name)
    append_to_table(df, out, str(tmp_path / f"{name}-state")).awaitTermination()
    return spark.read.parquet(out)


def sums():
    return [F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")]


def test_windows_close_with_the_watermark(spark, schema, tmp_path, rows):
    src = str(tmp_path / "src")
    put(src, "1.json", FIRST)
    put(src, "2.json", SECOND)
    plain = spark.read.schema(schema).json(src)
    batch = tumbling(plain, "event_timestamp", "1 hour", ["store"], sums())
    assert rows(batch, "store", "n") == [("a", 4), ("b", 1)]
    stream = tumbling(plain_stream(spark, src, schema), "event_timestamp", "1 hour", ["store"], sums(), "5 minutes")
    # The 8:00 window is written once the event of 10:10 has moved the watermark; 10:00 stays open.
    assert rows(run_append(spark, stream, tmp_path, "short"), "store", "n") == [("a", 4)]
    patient = tumbling(plain_stream(spark, src, schema), "event_timestamp", "1 hour", ["store"], sums(), "3 hours")
    out = str(tmp_path / "patient")
    upsert_stream(patient, epoch_writer(out), str(tmp_path / "patient-state")).awaitTermination()
    last = latest_per_key(spark.read.option("basePath", out).parquet(f"{out}/epoch=*"), ["window_start", "store"], ["epoch"])
    assert rows(last, "store", "n", "revenue") == [("a", 4, 13.0), ("b", 1, 4.0)]


def plain_stream(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)


def test_sliding_windows_overlap(spark, rows):
    df = spark.createDataFrame([(1, minutes(40))], "id int, t timestamp_ntz")
    got = tumbling(df, "t", "60 minutes", [], [F.count(F.lit(1)).alias("n")], slide="30 minutes")
    assert got.count() == 2


def test_stream_dedup(spark, schema, tmp_path, rows):
    src = str(tmp_path / "src")
    put(src, "1.json", FIRST)
    put(src, "2.json", [(2, "a", minutes(30), 2.0), (5, "b", minutes(31), 1.0)])
    once = dedup_stream(plain_stream(spark, src, schema), ["event_id"], "event_timestamp", "1 hour")
    assert rows(run_append(spark, once, tmp_path, "once"), "event_id") == [(1,), (2,), (5,)]


def test_interval_join_inner_and_left(spark, tmp_path, rows):
    orders = [(1, minutes(0)), (2, minutes(10)), (3, minutes(600))]
    paid = [(1, minutes(3), "ok"), (1, minutes(9), "late"), (2, minutes(9), "early"), (9, minutes(601), "other")]
    a = spark.createDataFrame(orders, "o int, ots timestamp_ntz")
    b = spark.createDataFrame(paid, "o int, pts timestamp_ntz, s string")
    args = (["o"], "ots", "pts", "0 seconds", "5 minutes")
    assert rows(interval_join(a, b, *args), "o", "s") == [(1, "ok")]
    assert rows(interval_join(a, b, *args, bucket=60), "o", "s") == [(1, "ok")]
    for name, df in (("a", a), ("b", b)):
        df.write.parquet(str(tmp_path / name))
    stream = {n: spark.readStream.schema(df.schema).parquet(str(tmp_path / n)) for n, df in (("a", a), ("b", b))}
    left = run_append(spark, interval_join(stream["a"], stream["b"], *args, how="left_outer"), tmp_path, "left")
    # Order 3 is still open: the watermark has not passed its interval.
    assert rows(left, "o", "s") == [(1, "ok"), (2, None)]


def test_late_rows_go_to_their_own_output(spark, rows):
    df = spark.createDataFrame(
        [(1, T0, T0), (2, T0, minutes(5)), (3, T0, minutes(5) + dt.timedelta(microseconds=1)), (4, T0, None)],
        "id int, t timestamp_ntz, c timestamp_ntz",
    )
    on_time, late = split_late(df, "t", "c", 300)
    assert rows(on_time, "id") == [(1,), (2,), (4,)] and rows(late, "id") == [(3,)]


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, rows):
    write = epoch_writer(str(tmp_path / "u"))
    for epoch, value in ((0, 1), (1, 2), (1, 2)):
        write(spark.createDataFrame([("k", value)], "k string, v int"), epoch)
    got = latest_per_key(spark.read.parquet(str(tmp_path / "u")), ["k"], ["epoch"])
    assert rows(got, "k", "v") == [("k", 2)]
