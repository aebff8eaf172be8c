"""Activity per entity and window with a trailing baseline, kept in stream state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ingest import with_watermark


def burst_windows(
    df: DataFrame, keys: Sequence[str], ts: str, counts: dict, minutes: int = 30, trailing: int = 4,
    factor: float = 3.0, least: int = 3, lateness: str = "5 minutes",
) -> DataFrame:
    """Closed windows per entity: counts, the mean of the first count over the ``trailing`` windows before, and a flag.

    ``counts`` maps a name to a condition; the first one is watched. A window is a burst when that count is at
    least ``least`` and ``factor`` times the baseline; windows without rows count 0 in it. A window is emitted
    once, when the watermark is past its end. NULL keys take no part.

    One aggregation over sliding windows that hold a window and the ``trailing`` ones before it, and end with it: its
    state are sums, combined before the shuffle, and go when the watermark is past their end. Only rows that the
    baseline counts go into windows other than their own.
    """
    keys, names = list(keys), list(counts)
    rows = with_watermark(df.dropna(subset=[*keys, ts]), ts, lateness)
    slim = rows.select(*keys, F.col(ts).alias("_at"), *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in counts.items()])
    length, slide = f"{minutes * (trailing + 1)} minutes", f"{minutes} minutes"
    placed = slim.withColumn("_window", F.window("_at", length, slide))
    placed = placed.withColumn("_own", F.col("_at") >= F.col("_window.end") - F.expr(f"INTERVAL {slide}"))
    own = lambda n: F.coalesce(F.sum(F.when(F.col("_own"), F.col(n))), F.lit(0))
    sums = placed.filter(F.col("_own") | (F.col(names[0]) != 0)).groupBy(*keys, "_window").agg(
        F.count_if("_own").alias("_rows"), *[own(n).alias(n) for n in names],
        F.coalesce(F.sum(F.when(~F.col("_own"), F.col(names[0]))), F.lit(0)).alias("_before"),
    )
    watched = F.col(names[0])
    return sums.filter("_rows > 0").select(
        *keys, (F.col("_window.end") - F.expr(f"INTERVAL {slide}")).alias("window_start"), *names,
        (F.col("_before").cast("double") / trailing).alias("baseline"),
        ((watched >= least) & (watched * trailing >= F.col("_before") * F.lit(float(factor)))).alias("burst"),
    )
