"""Split, baseline, comparison, chunks and retrieval against plain Python."""

import datetime as dt
import hashlib
import random
import re

import pytest

from lakeloom.operators.retrieval import SENTENCE, chunks, index_state, ranked_metrics
from lakeloom.plans import learning
from lakeloom.plans.runner import Stage, StreamRecords, append_records, read_records, run_stages
from lakeloom.streaming.ingest import append_to_table
from pyspark.sql import Observation
from pyspark.sql import functions as F

T0 = dt.datetime(2025, 1, 1)


def labelled(spark, n=3000):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        x, y = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, i % 40, T0 + dt.timedelta(days=i % 300), x if i % 17 else None, y, int(x + 0.5 * y + rng.gauss(0, 0.3) > 0.8)))
    return spark.createDataFrame(rows, "i int, who int, at timestamp_ntz, x double, y double, label int")


def test_nothing_of_the_future_in_train(spark):
    parts = learning.time_split(labelled(spark), "at", "2025-07-01", "30 days")
    late = parts.groupBy("split").agg(F.max(F.expr("at + INTERVAL 30 DAY")).alias("known"), F.min("at").alias("first"))
    rows = {r.split: r for r in late.collect()}
    assert rows["train"].known <= dt.datetime(2025, 7, 1) <= rows["test"].first and set(rows) == {"train", "gap", "test"}
    no_time = spark.createDataFrame([(None,)], "at timestamp_ntz")
    assert learning.time_split(no_time, "at", "2025-07-01").first().split == "gap"


def test_baseline_beats_the_larger_class(spark):
    parts = learning.time_split(labelled(spark), "at", "2025-07-01").cache()
    model = learning.fit_baseline(parts.filter("split = 'train'"), ["x", "y"], "label")
    test = learning.scored(model, parts.filter("split = 'test'"), ["x", "y"])
    assert test.columns == [*parts.columns, "score"] and test.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    found = learning.confusion(test, "label", "score").first()
    rows = [(r.label, r.score >= 0.5) for r in test.collect()]
    cells = [sum(a == y and b == h for y, h in rows) for a, b in ((1, True), (0, True), (1, False), (0, False))]
    assert [found.tp, found.fp, found.fn, found.tn] == cells
    assert found.accuracy > max(sum(y for y, _ in rows), len(rows) - sum(y for y, _ in rows)) / len(rows) + 0.05
    assert found.f1 == pytest.approx(2 * found.precision * found.recall / (found.precision + found.recall))


def test_baseline_after_an_observed_frame(spark):
    parts = learning.time_split(labelled(spark), "at", "2025-07-01").cache()
    seen = Observation("rows before the model")
    parts.observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get["rows"] > 0
    model = learning.fit_baseline(parts.filter("split = 'train'"), ["x", "y"], "label")
    test = learning.scored(model, parts.filter("split = 'test'"), ["x", "y"])
    assert test.filter("score IS NOT NULL").count() == test.count() > 0


def test_confusion_without_rows_and_labels(spark):
    df = spark.createDataFrame([(None, 0.7), (1, None)], "label int, score double")
    got = learning.confusion(df, "label", "score").first()
    assert (got.tp, got.fp, got.fn, got.tn, got.precision, got.f1) == (0, 0, 0, 0, None, None)


def test_bootstrap_is_the_same_for_any_partitioning(spark):
    df = labelled(spark).select("who", "label", (F.col("x") > 0.8).cast("double").alias("a"), F.col("y").alias("b"))
    got = {tuple(learning.compared(d, "who", "label", "a", "b").first()) for d in (df.coalesce(1), df.repartition(9), df.orderBy("b"))}
    assert len(got) == 1
    (row,) = got
    assert row[4] <= row[3] <= row[5] and row[4] < row[5]


def test_bootstrap_weights_are_poisson(spark):
    sums = spark.range(4000).select(F.array(*learning.bootstrap_weights(F.col("id"), F.lit(0)), *learning.bootstrap_weights(F.col("id"), F.lit(1))).alias("w")).collect()
    flat = [w for r in sums for w in r.w]
    mean = sum(flat) / len(flat)
    assert abs(mean - 1) < 0.02 and abs(sum((w - mean) ** 2 for w in flat) / len(flat) - 1) < 0.03
    hex_ = hashlib.md5(b"5:1").hexdigest()[4:8]
    assert sums[5].w[9] == sum(int(hex_, 16) >= t for t in learning.poisson_limits())


# --- chunks ---------------------------------------------------------------------------------


def greedy(text, budget, overlap):
    parts = [p for s in (m.group() for m in re.finditer(SENTENCE, text)) for p in (s[i : i + budget] for i in range(0, len(s), budget))]
    out, at, start, mark = [], 0, 0, 0
    for s in parts:
        if at + len(s) - start > budget:
            out.append((start, at))
            start = mark if mark > start and at - mark <= overlap and at - mark + len(s) <= budget else at
        mark, at = at, at + len(s)
    return out + ([(start, at)] if at else [])


def test_chunks_against_a_loop(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "...", "One.", "x" * 95, "é\U0001f600 ab. " * 40, "\n\nLine\nline\n", "a. " * 3000]
    for _ in range(30):
        texts.append("".join(rng.choice(["word ", "Wörd. ", "no? ", "yes!\n", "y" * rng.randint(1, 60), "..", "\t"]) for _ in range(rng.randint(1, 80))))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {}
    for r in chunks(df, "text", 40, 15).orderBy("i", "chunk").collect():
        got.setdefault(r.i, []).append((r.chunk_start, r.chunk_end))
        assert r.chunk_text == texts[r.i][r.chunk_start : r.chunk_end] and len(r.chunk_text) <= 40
    for i, text in enumerate(texts):
        want = greedy(text or "", 40, 15)
        assert got.get(i, []) == want
        assert set().union(*(range(a, b) for a, b in want)) == set(range(len(text or "")))


# --- retrieval ------------------------------------------------------------------------------


def test_ranked_metrics(spark):
    results = [("q1", "b", 0.9), ("q1", "a", 0.9), ("q1", "c", 0.1), ("q1", "c", 0.95), ("q2", "z", 1.0), ("q3", "x", None)]
    judged = [("q1", "b"), ("q1", "b"), ("q1", "d"), ("q4", "a")]
    got = ranked_metrics(
        spark.createDataFrame(results, "q string, item string, s double"), spark.createDataFrame(judged, "q string, item string"), "q", "item", "s", 3
    )
    rows = {r.q: tuple(r)[1:] for r in got.collect()}
    assert rows == {
        "q1": (3, 2, 1 / 3, 0.5, 1 / 3),  # c, a, b: equal scores by item, a repeated item at its best place
        "q2": (1, 0, 0.0, None, 0.0), "q3": (1, 0, 0.0, None, 0.0), "q4": (0, 1, 0.0, 0.0, 0.0),
    }


def test_index_state(spark):
    docs = spark.createDataFrame([(1, T0), (1, T0 + dt.timedelta(5)), (2, T0), (3, T0), (4, None)], "k int, at timestamp_ntz")
    index = spark.createDataFrame([(1, T0 + dt.timedelta(2)), (2, T0), (4, T0), (9, T0), (3, None)], "k int, made timestamp_ntz")
    assert tuple(index_state(docs, index, "k", "at", "made").first()) == (4, 4, 3, 1, 1.0)


# --- run records ------------------------------------------------------------------------------


def test_a_repeated_run_replaces_its_records(spark, tmp_path):
    log, calls = str(tmp_path / "log"), []

    def sometimes():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("down")
        return {"t": 7}

    stages = [Stage("a", lambda: {"x": 1, "y": 2}), Stage("b", sometimes)]
    for run_id in ("007", "008", "007"):
        append_records(spark, run_stages(spark, stages, retries=0), log, run_id)
    got = sorted((r.run_id, r.position, r.status, r.rows_written) for r in read_records(spark, log).collect())
    assert got == [("007", 0, "success", 3), ("007", 1, "success", 7), ("008", 0, "success", 3), ("008", 1, "failed", None)]
    with pytest.raises(ValueError):
        append_records(spark, run_stages(spark, []), log, "../elsewhere")


def test_streams_are_recorded(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "in"))
    counts = StreamRecords()
    spark.streams.addListener(counts)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        append_to_table(stream, str(tmp_path / "out"), str(tmp_path / "state"), name="good").awaitTermination()
        broken = stream.select(F.raise_error(F.lit("no good")).cast("string").alias("x"))
        query = append_to_table(broken, str(tmp_path / "out2"), str(tmp_path / "state2"), name="bad")
        with pytest.raises(Exception):
            query.awaitTermination()
        rows = {r.stage: r for r in counts.records(spark, ["good", "bad"]).collect()}
    finally:
        spark.streams.removeListener(counts)
    assert (rows["good"].status, rows["good"].attempts, rows["good"].rows_written) == ("success", 3, 100)
    assert rows["bad"].status == "failed" and rows["bad"].message
    with pytest.raises(TimeoutError):
        counts.records(spark, ["unknown"], wait=0.1)
