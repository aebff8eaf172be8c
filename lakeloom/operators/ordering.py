"""Whole-table order without a one-task window.

``ordered_slices`` range-partitions and sorts a frame once and writes the result to the
checkpoint folder. Range bounds come from a sample, so they must not be drawn again by a later
job or a retry: the written copy fixes them. After that, a running value over the whole order
needs only one small number per slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above, the row number below


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted by ``order``; equal rows may go on in the next partition.

    The number of the task a row comes from (the same after a retry) is the last sort key, so a
    value or a row that holds much of the table does not have to fit into one partition.
    """
    tied = df.withColumn("_tie", F.spark_partition_id())
    return tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")


def ordered_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_slice`` and ``_pos`` (from 0): sorting by the two is sorting by ``order``."""
    shared_dir(df.sparkSession)
    return (
        _ranged(df, order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_slice", F.shiftrightunsigned("_place", _ROW_BITS))
        .withColumn("_pos", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place")
    )


def _before(slices: DataFrame, value: Column, out: str) -> DataFrame:
    """Per slice, ``value`` aggregated over all earlier slices.

    The window has no partitioning, but one row per slice: at most as many as range partitions.
    """
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return slices.select("_slice", value.over(earlier).alias(out))


def dense_key(df: DataFrame, order: str | Sequence[str], out: str, start: int | Column = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in the order of a unique column (or columns)."""
    placed = ordered_slices(df, [order] if isinstance(order, str) else order)
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = F.broadcast(_before(sizes, F.sum("_n"), "_offset"))  # one row per slice
    first = F.lit(start) if isinstance(start, int) else start
    key = (F.coalesce("_offset", F.lit(0)) + F.col("_pos") + first).cast("bigint")
    return placed.join(offsets, "_slice").select(key.alias(out), *df.columns)


def extend_keys(df: DataFrame, existing: DataFrame, id_col: str, out: str) -> DataFrame:
    """Keep the keys in ``existing (id_col, out)`` and number only new ids, after the highest.

    A NULL id is no id and gets no key.
    """
    fresh = df.select(id_col).filter(F.col(id_col).isNotNull()).distinct().join(existing.select(id_col), id_col, "left_anti")
    top = existing.agg(F.coalesce(F.max(out), F.lit(0)) + 1).scalar()
    return existing.select(out, id_col).unionByName(dense_key(fresh, id_col, out, top))


def _running(df: DataFrame, agg: Callable[[str], Column], value: str, order: Sequence[str]) -> DataFrame:
    """Add ``_local``, the aggregate so far within the slice, and ``_carried``, that of earlier slices."""
    placed = ordered_slices(df, order)
    totals = placed.groupBy("_slice").agg(agg(value).alias("_total"))
    carried = F.broadcast(_before(totals, agg("_total"), "_carried"))  # one row per slice
    so_far = Window.partitionBy("_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("_local", agg(value).over(so_far)).join(carried, "_slice")


def running_max(df: DataFrame, value: str, order: Sequence[str], out: str) -> DataFrame:
    """Largest ``value`` so far (own row included) in the order of the given columns."""
    return _running(df, F.max, value, order).select(*df.columns, F.greatest("_local", "_carried").alias(out))


def running_sum(df: DataFrame, value: str, order: Sequence[str], out: str) -> DataFrame:
    """Sum of ``value`` so far (own row included) in the order of the given columns."""
    total = F.coalesce("_carried", F.lit(0)) + F.col("_local")
    return _running(df, F.sum, value, order).select(*df.columns, total.alias(out))


def quantiles(df: DataFrame, col: str, marks: Sequence[float]) -> DataFrame:
    """Exact quantiles: one row with the array ``cuts``, the smallest value that reaches each mark.

    Equal values collapse to a count first; then a running sum over the distinct values.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    reached = running_sum(counts, "_n", [col], "_reached")
    n = df.agg(F.count(col)).scalar()
    cuts = [F.min(F.when(F.col("_reached") >= n - F.floor(n - n * F.lit(m)), F.col(col))) for m in marks]
    return reached.agg(F.array(*cuts).alias("cuts"))


def write_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Globally sorted output: part files follow one another, each one is sorted."""
    return _ranged(df, order)


def keyed_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: Sequence[str] = (), sums: Sequence[str] = ()
) -> DataFrame:
    """State of each row's key so far, own row included, in the order of the given columns.

    The columns ``last`` become their last non-NULL value, the columns ``sums`` their sum so far. The
    whole table is put in order by key and order once; a key of any size goes on over several slices, and
    what it brings from earlier ones is one small row per slice. NULL keys are a key of their own.
    """
    keys, kept = list(keys), df.columns
    placed = ordered_slices(df, [*keys, *order])
    so_far = Window.partitionBy("_slice", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns(
        {c: F.last(c, ignorenulls=True).over(so_far) for c in last} | {c: F.sum(c).over(so_far) for c in sums}
    )

    # Only the last key of a slice goes on, and only into slices that begin with it.
    ends = placed.groupBy("_slice").agg(F.max("_pos").alias("_pos"))
    last_keys = placed.select("_slice", "_pos", *keys).join(F.broadcast(ends), ["_slice", "_pos"])  # one row per slice
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    same = F.lit(True)
    for k, renamed in names.items():
        same = same & F.col(k).eqNullSafe(F.col(renamed))
    edge = F.broadcast(last_keys.select(F.col("_slice").alias("_carried_slice"), *[F.col(k).alias(n) for k, n in names.items()]))
    of_last = placed.join(edge, (F.col("_slice") == F.col("_carried_slice")) & same)
    states = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(c) for c in last] + [F.sum(c).alias(c) for c in sums]
    left = of_last.groupBy("_slice", *keys).agg(*states).withColumn("_begins", F.lit(False))
    begun = placed.filter("_pos = 0").select("_slice", *keys).withColumn("_begins", F.lit(True))
    earlier = Window.partitionBy(*keys).orderBy("_slice", F.desc("_begins")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        left.unionByName(begun, allowMissingColumns=True)
        .withColumns({c: F.last(c, ignorenulls=True).over(earlier) for c in last} | {c: F.sum(c).over(earlier) for c in sums})
        .filter("_begins")
        .select(F.col("_slice").alias("_carried_slice"), *[F.col(k).alias(n) for k, n in names.items()], *[F.col(c).alias(f"_c_{c}") for c in [*last, *sums]])
    )
    met = local.join(F.broadcast(carried), (F.col("_slice") == F.col("_carried_slice")) & same, "left")  # one row per slice
    values = {c: F.coalesce(c, f"_c_{c}") for c in last} | {c: F.coalesce(f"_c_{c}", F.lit(0)) + F.col(c) for c in sums}
    return met.select(*[values.get(c, F.col(c)).alias(c) for c in kept])


def rolling_sums(
    df: DataFrame, keys: Sequence[str], ts: str, span: str, sums: dict[str, Column], closed: str = "right"
) -> DataFrame:
    """Per distinct (key, time): each sum over the rows of the key in the ``span`` (an interval) up to that time.

    ``closed`` says whether a row that is exactly ``span`` old still counts (``both``) or not (``right``).
    Rows of one key and time shrink to one first. Each of these then enters at its time and leaves at
    time plus span, as two signed rows of one running sum: nothing is copied per bucket, however long the span.
    Rows with a NULL key or time do not count.
    """
    if closed not in ("right", "both"):
        raise ValueError(f"closed must be right or both, not {closed!r}")
    keys = list(keys)
    known = df.dropna(subset=[*keys, ts])
    at_time = known.groupBy(*keys, F.col(ts).alias("_t")).agg(*[v.alias(f"_{n}") for n, v in sums.items()])
    values = [f"_{n}" for n in sums]
    entering = at_time.select(*keys, "_t", F.lit(1).alias("_side"), *values, *[F.col(v).alias(f"_at{v}") for v in values])
    leaving = at_time.select(
        *keys, (F.col("_t") + F.expr(f"INTERVAL {span}")).alias("_t"), F.lit(0 if closed == "right" else 2).alias("_side"),
        *[(-F.col(v)).alias(v) for v in values], *[F.lit(None).cast(at_time.schema[v].dataType).alias(f"_at{v}") for v in values],
    )
    running = keyed_running(entering.unionByName(leaving), keys, ["_t", "_side"], sums=values)
    return running.filter("_side = 1").select(
        *keys, F.col("_t").alias(ts), *[F.col(f"_at{v}").alias(f"{n}_at_time") for n, v in zip(sums, values)],
        *[F.col(v).alias(n) for n, v in zip(sums, values)],
    )


def rolling_count(df: DataFrame, key: str, ts: str, minutes: int, out: str) -> DataFrame:
    """Rows of the same key in the ``minutes`` up to and including each distinct time."""
    found = rolling_sums(df, [key], ts, f"{minutes} minutes", {"n": F.count(F.lit(1))}, closed="both")
    return found.select(key, ts, F.col("n_at_time").alias("rows_at_time"), F.col("n").cast("bigint").alias(out))
