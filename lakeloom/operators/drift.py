"""Distribution drift between a baseline and a current sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import quantiles


def psi(
    base: DataFrame, cur: DataFrame, col: str, bins: int = 10, alert: float = 0.15, exact: bool = True
) -> DataFrame:
    """Population stability index over quantile bins of the baseline.

    One row per bin with both shares and the bin's part of the index, plus the total and the
    alert flag on each row. Only the cut points and one count per bin leave the big tables.
    An empty bin counts as a share of 0.0001. ``exact=False`` takes the cut points from a quantile
    sketch, which saves the sort of the baseline's distinct values. Without current values every
    share of the current sample counts as that of an empty bin; without a baseline there are no cut
    points and all current values fall into one bin.
    """
    marks = [i / bins for i in range(1, bins)]
    if exact:
        found = quantiles(base, col, marks)
    else:
        found = base.agg(F.percentile_approx(col, marks, 100_000).alias("cuts"))
    cuts = found.select(F.array_distinct("cuts")).scalar()

    def shares(df, name):
        slot = F.size(F.filter(F.col("_cuts"), lambda c: c < F.col(col)))
        counted = (
            df.filter(F.col(col).isNotNull())
            .select(col, cuts.alias("_cuts"))
            .groupBy(slot.cast("bigint").alias("bin"))
            .agg(F.count(F.lit(1)).alias(f"{name}_rows"))
        )
        return counted

    both = shares(base, "base").join(shares(cur, "cur"), "bin", "full_outer").fillna(0)
    every = Window.partitionBy()  # one row per bin

    def share(c):
        return F.greatest(F.try_divide(F.col(c).cast("double"), F.sum(c).over(every)), F.lit(0.0001))

    b, c = share("base_rows"), share("cur_rows")
    parts = both.withColumn("_part", (c - b) * F.log(c / b))
    whole = F.sum("_part").over(every)
    return parts.select(
        "bin",
        "base_rows",
        "cur_rows",
        F.round("_part", 6).alias("psi_part"),
        F.round(whole, 6).alias("psi"),
        (whole > alert).alias("drifted"),
    )
