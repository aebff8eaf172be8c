"""Faults put into a frame on purpose, as pure functions of the row key.

No random numbers: the same rows are hit whatever the partitioning, so an SQL engine can
reproduce the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import plus_seconds

SPREAD = 7919  # prime that scatters consecutive keys


def inject_copies(df: DataFrame, key: str, every: int) -> DataFrame:
    """Append an exact copy of each row whose key is a multiple of ``every``."""
    return df.unionByName(df.filter(F.col(key) % every == 0))


def inject_nulls(df: DataFrame, key: str, col: str, every: int, rest: Sequence[int] = (0,)) -> DataFrame:
    """NULL in ``col`` where the key leaves one of the given remainders."""
    return df.withColumn(col, F.when(~(F.col(key) % every).isin(*rest), F.col(col)))


def inject_late(
    df: DataFrame, key: str, ts: str, out: str, share: tuple[int, int] = (3, 25), delay: tuple[int, int] = (30, 3600)
) -> DataFrame:
    """Write time = event time + delay: long for ``share`` of the rows, 0-4 s for the others."""
    hit, of = share
    low, high = delay
    k = F.col(key)
    seconds = F.when(k % of < hit, low + (k * SPREAD) % (high - low)).otherwise(k % 5)
    return df.withColumn(out, plus_seconds(ts, seconds))


def inject_skew(key: str, percent: int, hot: int, others: Column | int) -> Column:
    """Assignment to one of ``others`` places where ``percent`` of the rows share ``hot`` places."""
    k = F.col(key)
    spread = (k * SPREAD) % (F.lit(others) if isinstance(others, int) else others)
    return F.when(k % 100 < percent, F.expr(f"{key} div 100") % hot).otherwise(spread).cast("bigint")


def inject_burst(key: str, hours: Sequence[int], weights: Sequence[int]) -> Column:
    """Hour of day, each hour as often as its weight says."""
    slots = [hour for hour, weight in zip(hours, weights) for _ in range(weight)]
    table = F.array(*[F.lit(h) for h in slots])
    return F.get(table, ((F.col(key) * SPREAD) % len(slots)).cast("int"))


def absent_before(date: str, launch: str, col: str) -> Column:
    """The column, NULL before the launch date."""
    return F.when(F.col(date) >= F.lit(launch).cast("timestamp_ntz"), F.col(col))
