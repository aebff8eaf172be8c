"""One row per key, by aggregation.

A ``row_number`` window would bring every copy of a key into one task before dropping any of
them. Taking the smallest or largest row with ``min``/``max`` over a struct gives the same
answer, but each map task first shrinks its own copies to one row, so a key that holds a third
of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], biggest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in order if c in rest]
    fields = lead + [c for c in rest if c not in lead]
    if not fields:
        return df.select(*keys).distinct()
    row = F.struct(*fields)
    best = (F.max(row) if biggest else F.min(row)).alias("_row")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key by ``order``; ties fall to the smallest remaining columns.

    NULL sorts first. The result does not depend on partitioning.
    """
    return _pick(df, keys, order or [], biggest=False)


def dedup_copies(df: DataFrame) -> DataFrame:
    """Drop exact copies: a hash aggregation over all columns, no sorting."""
    return df.distinct()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order`` (event time, then created time, ...)."""
    return _pick(df, keys, order, biggest=True)


def latest_attrs(df: DataFrame, key: str, order: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Attributes of the latest row per key, all from that one row: ``{column: new name}``."""
    lead = [c for c in order if c not in cols] + [c for c in order if c in cols]
    fields = lead + [c for c in cols if c not in lead]
    last = df.groupBy(key).agg(F.max(F.struct(*fields)).alias("_row"))
    return last.select(key, *[F.col(f"_row.{c}").alias(name) for c, name in cols.items()])


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constants in place of NULL for the named columns."""
    return df.fillna(dict(values))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while the frame is used, without reading it a second time."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def dedup_report(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows before and after dedup by ``keys``, from per-key counts (one shuffle)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("rows_dropped"),
    )
