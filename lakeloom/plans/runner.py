"""Run the layers one after the other and keep a record of it."""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..operators.joins import all_whole, order_totals
from ..session import removed, scratch, settings
from ..sources.writers import write_table
from .checks import gold_checks
from .gold import dim_customer, dim_date, dim_employee, dim_product, dim_store, fact_plans
from .layers import build_silver, load_bronze

T = TypeVar("T")

AT_A_TIME = 8  # tables of a stage that are opened or written at a time

#: Shuffle files go when their job has ended, not when the driver's memory fills; tables in the smaller of the usual codecs.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}

RUN = "position INT, stage STRING, status STRING, attempts INT, seconds DOUBLE, rows_written BIGINT, message STRING"
EDGE = "input STRING, output STRING, stage STRING"


@dataclass(frozen=True)
class Stage:
    """A named step; ``run`` returns rows written per table and overwrites what it writes."""

    name: str
    run: Callable[[], Mapping[str, int]]
    reads: Sequence[str] = ()
    writes: Sequence[str] = ()


def run_stages(spark: SparkSession, stages: Sequence[Stage], retries: int = 1) -> DataFrame:
    """Stages in order, each tried again ``retries`` times; after a failure the rest is skipped."""
    records, failed = [], False
    for i, stage in enumerate(stages):
        if failed:
            records.append((i, stage.name, "skipped", 0, 0.0, None, None))
            continue
        start, message, rows = time.monotonic(), None, None
        for attempt in range(1, retries + 2):
            try:
                rows = sum(stage.run().values())
                message = None
                break
            except Exception as error:  # noqa: BLE001 - recorded, and the run stops below
                message = str(error).splitlines()[0] if str(error) else type(error).__name__
        failed = message is not None
        took = time.monotonic() - start
        records.append((i, stage.name, "failed" if failed else "success", attempt, took, rows, message))
    return spark.createDataFrame(records, RUN)


def append_records(spark: SparkSession, records: DataFrame, path: str, run_id: str) -> None:
    """Put the records of one run into the log at ``path``, with their run id and the time of the entry.

    A run that is repeated under its id replaces what it left before; other runs are not touched.
    """
    if not run_id or not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"a run id has letters, digits, dots and dashes only, not {run_id!r}")
    rows = records.drop("run_id").withColumn("recorded_at", F.current_timestamp())
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All runs of the log."""
    run_id = StructField("run_id", StringType())  # an id of digits stays text
    schema = StructType([run_id, *spark.createDataFrame([], RUN).schema.fields, StructField("recorded_at", TimestampType())])
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/run_id=*")


class StreamRecords(StreamingQueryListener):
    """Rows taken in and seconds spent per named stream, one record each when the stream ends.

    Register with ``spark.streams.addListener``; the counts come from the micro-batches' own progress.
    """

    def __init__(self) -> None:
        self._lock, self._open, self._done = threading.Condition(), {}, {}

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._open[str(event.runId)] = {"name": event.name or str(event.id), "batches": {}, "began": time.monotonic()}

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            entry = self._open.get(str(progress.runId))
            if entry is not None:
                entry["batches"][progress.batchId] = progress.numInputRows  # a batch that reports again counts once

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            entry = self._open.pop(str(event.runId), None)
            if entry is not None:
                message = event.exception.splitlines()[0][:500] if event.exception else None
                self._done[entry["name"]] = (
                    entry["name"], "failed" if message else "success", len(entry["batches"]),
                    time.monotonic() - entry["began"], sum(entry["batches"].values()), message,
                )
                self._lock.notify_all()

    def records(self, spark: SparkSession, names: Sequence[str], wait: float = 60.0) -> DataFrame:
        """Records of ended streams by name; ``attempts`` is the number of micro-batches. Waits for their last events."""
        with self._lock:
            if not self._lock.wait_for(lambda: all(n in self._done for n in names), timeout=wait):
                raise TimeoutError(f"no end seen of {', '.join(n for n in names if n not in self._done)}")
            rows = [(i, *self._done[n]) for i, n in enumerate(names)]
        return spark.createDataFrame(rows, RUN)


def lineage(spark: SparkSession, stages: Sequence[Stage]) -> DataFrame:
    """Edges from each table a stage reads to each it writes."""
    edges = [(r, w, s.name) for s in stages for r in s.reads for w in s.writes]
    return spark.createDataFrame(edges, EDGE)


def at_a_time(tasks: Mapping[str, Callable[[], T]], most: int = AT_A_TIME) -> dict[str, T]:
    """Results of independent tasks by name, ``most`` of them at a time; the first failure is raised when all have ended.

    The jobs of one task that leave executors idle (a few rows, a look at keys) run beside those of others.
    """
    with ThreadPoolExecutor(max_workers=most) as pool:
        started = {name: pool.submit(task) for name, task in tasks.items()}
    return {name: task.result() for name, task in started.items()}


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Parquet folders by name, opened beside each other: each one's schema is a small job."""
    return at_a_time({name: lambda path=path: spark.read.parquet(path) for name, path in paths.items()})


def retail_stages(spark: SparkSession, sources: Mapping[str, str], out: str) -> list[Stage]:
    """Bronze, Silver, Gold and checks; each stage reads what the one before has written.

    While a stage runs, the session has the settings ``LEAN``: what the disks hold beside the tables is bounded by the
    shuffles of the widest write.
    """
    names = list(sources)
    dims = ["dim_date", "dim_customer", "dim_product", "dim_store", "dim_employee"]
    facts = ["fact_orders", "fact_order_items", "obt_order_performance", "feat_customer_90d"]

    def load(layer: str, tables: Sequence[str]) -> dict[str, DataFrame]:
        return read_tables(spark, {t: f"{out}/{layer}/{t}" for t in tables})

    def save(layer: str, plans: Mapping[str, Callable[[], DataFrame]], most: int = AT_A_TIME) -> dict[str, int]:
        # A plan may run jobs of its own (keys, sizes, checkpoints), so it is made beside the other writes too.
        return at_a_time({t: lambda t=t, plan=plan: write_table(plan(), f"{out}/{layer}/{t}") for t, plan in plans.items()}, most)

    def made(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
        return {t: lambda df=df: df for t, df in tables.items()}

    def line_totals(items: DataFrame, path: str) -> DataFrame:
        whole = all_whole(items, "line_amount")
        totals = order_totals(items, "order_id", "line_amount", whole=whole)
        totals.write.parquet(path)
        return spark.read.schema(totals.schema).parquet(path)

    def lean(run: Callable[[], dict[str, int]]) -> Callable[[], dict[str, int]]:
        def run_lean():
            with settings(spark, LEAN):
                return run()

        return run_lean

    def bronze():
        return save("bronze", made(load_bronze(spark, sources)))

    def silver():
        return save("silver", made(build_silver(load("bronze", names))))

    def gold():
        clean, totals_path = load("silver", names), scratch(spark, "order-totals")
        try:
            return gold_tables(clean, totals_path)
        finally:
            removed(spark, totals_path)

    def gold_tables(clean: Mapping[str, DataFrame], totals_path: str) -> dict[str, int]:
        with ThreadPoolExecutor(max_workers=2) as beside:
            dims_written = beside.submit(
                save,
                "gold",
                {
                    "dim_date": lambda: dim_date(clean["orders"]),
                    "dim_customer": lambda: dim_customer(clean["customers"]),
                    "dim_product": lambda: dim_product(clean["products"]),
                    "dim_store": lambda: dim_store(clean["stores"]),
                    "dim_employee": lambda: dim_employee(clean["employees"]),
                },
            )
            # Two tables take the totals of all lines: summed once.
            totals = beside.submit(line_totals, clean["order_items"], totals_path)

            def dims_read():
                dims_written.result()
                return load("gold", dims)

            # The joins of a fact shuffle most of its rows, some more than once: planned beside each other, but
            # written one after the other, so the disks hold the shuffles of one fact only.
            planned = at_a_time(fact_plans(clean, dims_read, totals.result))
            written = save("gold", made(planned), most=1)
        return dims_written.result() | written

    def checks():
        built = load("gold", facts)
        rows = gold_checks(built["fact_orders"], built["fact_order_items"], load("silver", ["orders"])["orders"])
        return save("gold", made({"dq_results": rows.withColumn("checked_at", F.current_timestamp())}))

    return [
        Stage("bronze", lean(bronze), [f"source.{n}" for n in names], [f"bronze.{n}" for n in names]),
        Stage("silver", lean(silver), [f"bronze.{n}" for n in names], [f"silver.{n}" for n in names]),
        Stage("gold", lean(gold), [f"silver.{n}" for n in names], [f"gold.{n}" for n in dims + facts]),
        Stage("checks", lean(checks), ["gold.fact_orders", "gold.fact_order_items", "silver.orders"], ["gold.dq_results"]),
    ]
