import threading
import time

import pyarrow.parquet as pq
import pytest

from lakeloom.operators.joins import order_totals
from lakeloom.plans import gold, runner
from lakeloom.plans.runner import LEAN, Stage, at_a_time, lineage, retail_stages, run_stages
from lakeloom.queries import history, raw
from lakeloom.session import settings
from lakeloom.sources.writers import write_monthly, write_table

from . import retail


def test_retry_then_skip(spark):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise RuntimeError("first try")
        return {"t": 3}

    def broken():
        raise RuntimeError("no good")

    stages = [Stage("flaky", flaky, ["a"], ["b"]), Stage("broken", broken), Stage("after", lambda: {})]
    got = [(r.stage, r.status, r.attempts, r.rows_written, r.message) for r in run_stages(spark, stages).orderBy("position").collect()]
    assert got == [("flaky", "success", 2, 3, None), ("broken", "failed", 2, None, "no good"), ("after", "skipped", 0, None, None)]
    assert [tuple(r) for r in lineage(spark, stages).collect()] == [("a", "b", "flaky")]


def test_whole_run_twice(spark, tmp_path, rows):
    sources = {}
    for name, df in retail.tables(spark).items():
        sources[name] = str(tmp_path / "source" / name)
        if name == "orders":
            write_monthly(df, "order_date", sources[name], "2025-04-01", ["channel", "membership_tier_at_order"])
        else:
            write_table(df, sources[name])
    lake = str(tmp_path / "lake")
    stages = retail_stages(spark, sources, lake)
    before = None
    for _ in range(2):
        record = run_stages(spark, stages).orderBy("position").collect()
        assert [(r.stage, r.status, r.attempts) for r in record] == [(s, "success", 1) for s in ("bronze", "silver", "gold", "checks")]
        facts = rows(spark.read.parquet(f"{lake}/gold/fact_orders"))
        assert before in (None, facts)
        before = facts
    checks = spark.read.parquet(f"{lake}/gold/dq_results").collect()
    assert len(checks) == 5 and all(r.passed for r in checks)
    assert ("silver.orders", "gold.fact_orders", "gold") in [tuple(r) for r in lineage(spark, stages).collect()]


def test_independent_tasks_run_beside_each_other():
    meet = threading.Barrier(2, timeout=30)  # each task waits for the other
    assert sorted(at_a_time({"a": meet.wait, "b": meet.wait}).values()) == [0, 1]


def test_failure_of_one_task_waits_for_the_others():
    failed, ended = threading.Event(), []

    def fail():
        failed.set()
        raise RuntimeError("no good")

    def slow():
        assert failed.wait(30)
        ended.append(1)

    with pytest.raises(RuntimeError, match="no good"):
        at_a_time({"fail": fail, "slow": slow})
    assert ended == [1]


def test_gold_sums_the_lines_once(spark, tmp_path, rows, monkeypatch):
    tables = retail.tables(spark)
    clean, sums = runner.build_silver(tables), []
    for name, df in clean.items():
        write_table(df, str(tmp_path / "silver" / name))

    def spied(*args, **kwargs):
        sums.append(1)
        return order_totals(*args, **kwargs)

    for module in (gold, runner):
        monkeypatch.setattr(module, "order_totals", spied, raising=False)
    stage = next(s for s in retail_stages(spark, dict.fromkeys(tables, ""), str(tmp_path)) if s.name == "gold")
    written = stage.run()
    assert len(sums) == 1
    monkeypatch.undo()
    for name, df in gold.build_gold(clean).items():
        assert written[name] == df.count()
        if name.startswith(("fact", "obt", "feat")):
            assert rows(spark.read.parquet(str(tmp_path / "gold" / name)), *df.columns) == rows(df)


def _shuffle_files(spark):
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_layer_counts_keeps_no_more_on_disk_than_the_layers(spark, tmp_path, monkeypatch):
    tables = retail.tables(spark)
    monkeypatch.setattr(raw, "raw_tables", lambda spark, d: tables)
    for module in (history, runner):
        monkeypatch.setattr(module, "scratch", lambda spark, name: str(tmp_path / name))
    before, late = _shuffle_files(spark), time.monotonic() + 30
    result = history.layer_counts(spark, "")
    while _shuffle_files(spark) - before and time.monotonic() < late:  # executors delete them in the background
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    counts = {r.table_name: r.row_count for r in result.collect()}
    assert len(counts) == 24
    assert {name: counts[f"bronze.{name}"] for name in tables} == {name: df.count() for name, df in tables.items()}
    assert [f.name for f in tmp_path.iterdir()] == ["retail"]  # no totals of the lines
    assert [f.name for f in (tmp_path / "retail").iterdir()] == ["lake"]  # no copy of bronze
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "retail").rglob("*.parquet")]
    assert {f.row_group(0).column(0).compression for f in files if f.num_row_groups} == {"ZSTD"}


def test_facts_are_written_one_after_the_other(spark, tmp_path, monkeypatch):
    lock, open_now, most = threading.Lock(), [], []
    for name, df in runner.build_silver(retail.tables(spark)).items():
        write_table(df, str(tmp_path / "silver" / name))

    def spied(df, path):
        fact = not path.rsplit("/", 1)[1].startswith("dim_")
        with lock:
            open_now.extend([path] * fact)
            most.append(len(open_now))
        time.sleep(0.3)
        rows = write_table(df, path)
        with lock:
            open_now[:] = [p for p in open_now if p != path]
        return rows

    monkeypatch.setattr(runner, "write_table", spied)
    next(s for s in retail_stages(spark, dict.fromkeys(retail.tables(spark), ""), str(tmp_path)) if s.name == "gold").run()
    assert max(most) == 1


def test_settings_hold_within_the_block_only(spark):
    shuffle, codec = LEAN
    spark.conf.set(codec, "gzip")
    before = spark.conf.get(shuffle, None)
    try:
        with pytest.raises(RuntimeError), settings(spark, LEAN):
            assert {key: spark.conf.get(key) for key in LEAN} == LEAN
            raise RuntimeError("no good")
        assert spark.conf.get(codec) == "gzip" and spark.conf.get(shuffle, None) == before
    finally:
        spark.conf.unset(codec)
