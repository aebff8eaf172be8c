"""Log roll-ups from mergeable quantile sketches.

The raw rows are read once, for the hour table. Days (or weeks) come from the hour table alone: counts and
sums add up, and the hours' KLL sketches merge to one of the same size. With ``SKETCH_K`` points a
quantile's rank is off by at most ``RANK_ERROR`` in 99 of 100 sketches, however many hours were merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 400
RANK_ERROR = 0.01


def hour_table(
    df: DataFrame, ts: str, value: str, dims: Sequence[str], failed: Column, sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """``dims``, ``hour``, rows as ``requests``, ``errors``, ``sums`` and a ``sketch`` of the values.

    NULL, NaN and infinite values count as requests but are not in the sketch; an hour without any
    value has no sketch. Sketches are combined in every task before the shuffle.
    """
    v = F.col(value).cast("double")
    plain = F.when(F.abs(v) < F.lit(float("inf")), v)
    return df.groupBy(*dims, F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(failed).alias("errors"),
        *[F.sum(c).alias(n) for n, c in (sums or {}).items()],
        F.when(F.count(plain) > 0, F.kll_sketch_agg_double(plain, F.lit(SKETCH_K))).alias("sketch"),
    )


def rolled_up(
    hours: DataFrame, dims: Sequence[str], marks: Mapping[str, float], unit: str = "day", sums: Sequence[str] = ()
) -> DataFrame:
    """Hours merged to ``unit``: requests, errors, error_rate, sums and the quantiles ``marks`` (name to share)."""
    whole = hours.groupBy(*dims, F.date_trunc(unit, "hour").alias(unit)).agg(
        F.sum("requests").alias("requests"),
        F.sum("errors").alias("errors"),
        *[F.sum(c).alias(c) for c in sums],
        F.when(F.count("sketch") > 0, F.kll_merge_agg_double("sketch", F.lit(SKETCH_K))).alias("_sketch"),
    )
    # The sketch functions want a number that is written out, so each mark is a column of its own.
    quantiles = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(share))).alias(n) for n, share in marks.items()]
    rate = F.try_divide(F.col("errors").cast("double"), F.col("requests"))
    return whole.select(*dims, unit, "requests", "errors", rate.alias("error_rate"), *sums, *quantiles)


def rank_bounds(df: DataFrame, value: str, cut: str, by: Sequence[str]) -> DataFrame:
    """Shares of values below, and at most at, the cut of their own row: where the cut's true rank lies."""
    n = F.count(value).cast("double")
    below, upto = F.count_if(F.col(value) < F.col(cut)), F.count_if(F.col(value) <= F.col(cut))
    return df.groupBy(*by).agg(F.try_divide(below, n).alias("rank_low"), F.try_divide(upto, n).alias("rank_high"))
