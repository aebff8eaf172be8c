"""Upserts and slowly changing dimensions on plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import _pick


def upsert(cur: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``cur`` replaced or joined by those of ``new``.

    With ``order`` the row that is last by it wins, wherever it comes from (a late change does
    not overwrite a newer row); otherwise, or on a tie, ``new`` wins. Union and one aggregation:
    no join, and repeated changes of one key shrink before the shuffle.
    """
    both = cur.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return _pick(both, keys, [*order, "_side"], biggest=True).drop("_side")


def scd2(
    history: DataFrame, new: DataFrame, keys: Sequence[str], attrs: Sequence[str], ts: str, close_missing: bool = False
) -> DataFrame:
    """Apply a snapshot taken at ``ts`` to a history with valid_from, valid_to, is_current.

    A changed row closes the open version and opens one; a new key opens one; an unchanged row
    stays. Keys absent from the snapshot stay open unless ``close_missing``. A snapshot that is
    not newer than the open version of a key does not touch that key.
    """
    keys, attrs = list(keys), list(attrs)
    at = F.lit(ts).cast("timestamp_ntz")
    cols = [*keys, *attrs, "valid_from", "valid_to", "is_current"]
    now = new.select(*keys, F.struct(*attrs).alias("_new"))
    open_now = history.filter("is_current").select(*keys, "valid_from", F.struct(*attrs).alias("_old"))
    pair = open_now.join(now, keys, "full_outer")
    newer = F.coalesce(F.col("valid_from") < at, F.lit(True))
    changed = F.col("_old").isNotNull() & F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new")) & newer
    gone = F.col("_new").isNull() & F.lit(close_missing) & newer
    none = F.lit(None).cast("timestamp_ntz")

    def version(row, start, end, current):
        return F.struct(row.alias("row"), start.alias("valid_from"), end.alias("valid_to"), current.alias("is_current"))

    old = version(F.col("_old"), F.col("valid_from"), F.when(changed | gone, at), ~(changed | gone))
    fresh = version(F.col("_new"), at, none, F.lit(True))
    versions = F.filter(
        F.array(
            F.when(F.col("_old").isNotNull(), old),
            F.when(F.col("_old").isNull() | changed, fresh),
        ),
        lambda v: v.isNotNull(),
    )
    live = pair.select(*keys, F.explode(versions).alias("v")).select(
        *keys,
        *[F.col(f"v.row.{a}").alias(a) for a in attrs],
        "v.valid_from",
        "v.valid_to",
        "v.is_current",
    )
    return history.filter("NOT is_current").select(*cols).unionByName(live.select(*cols))


def scd2_start(new: DataFrame, keys: Sequence[str], attrs: Sequence[str], ts: str) -> DataFrame:
    """First history: every row open since ``ts``."""
    return new.select(
        *keys,
        *attrs,
        F.lit(ts).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
