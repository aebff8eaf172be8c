"""Point-in-time joins of labels to feature rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import latest_per_key
from .ordering import keyed_running


@dataclass(frozen=True)
class Timeline:
    """A feature table to be read as of a time: its columns, and how long a row stays valid.

    ``created`` decides between rows of one entity and time: the last one wins. ``fields`` are the
    columns to attach (``None``: all others); ``seen`` is the output column for the time of the row found.
    """

    df: DataFrame
    time: str
    created: str | None = None
    ttl: str | None = None
    fields: Sequence[str] | None = None
    seen: str = "feature_time"


def merge_as_of(labels: DataFrame, timelines: Sequence[Timeline], keys: Sequence[str], label_time: str) -> DataFrame:
    """Every label row with the newest row of each timeline at or before the label's time.

    All timelines and the labels go into one union, are put in order once by entity and time, and one
    pass carries the newest row of every timeline along, so a further table costs no further shuffle.
    The order is cut into slices by its own quantiles, so an entity with very many rows, also within one
    second, spreads over tasks. At equal times a feature counts. A NULL entity or time matches nothing, and
    what is older than its table's ``ttl`` is NULL.
    """
    keys = list(keys)
    chosen = [list(t.fields) if t.fields is not None else [c for c in t.df.columns if c not in [*keys, t.time, t.created]] for t in timelines]
    out = [*labels.columns, *[c for t, fields in zip(timelines, chosen) for c in (t.seen, *fields)]]
    if len({c.lower() for c in out}) < len(out):
        raise ValueError(f"columns of labels and timelines clash: {', '.join(out)}")
    asked = labels.select(*keys, F.col(label_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*labels.columns).alias("_label"))
    rows = asked
    for i, (t, fields) in enumerate(zip(timelines, chosen)):
        known = t.df.dropna(subset=[*keys, t.time])
        rank = F.struct(*[F.col(c) for c in ([t.created] if t.created else []) + fields] or [F.lit(0)])
        state = F.struct(F.col(t.time).alias("seen"), *fields)
        rows = rows.unionByName(
            known.select(*keys, F.col(t.time).alias("_t"), F.lit(0).alias("_side"), rank.alias(f"_r{i}"), state.alias(f"_f{i}")),
            allowMissingColumns=True,
        )
    ranks, states = ([f"{c}{i}" for i in range(len(timelines))] for c in ("_r", "_f"))
    merged = keyed_running(rows, keys, ["_t", "_side", *ranks], last=states).filter("_side = 1")
    found = []
    for t, state, fields in zip(timelines, states, chosen):
        seen = F.col(f"{state}.seen")
        fresh = seen.isNotNull() & F.col("_t").isNotNull()
        if t.ttl is not None:
            fresh = fresh & (seen >= F.col("_t") - F.expr(f"INTERVAL {t.ttl}"))
        found += [F.when(fresh, F.col(f"{state}.{c}")).alias(name) for c, name in [("seen", t.seen), *zip(fields, fields)]]
    return merged.select("_label.*", *found)


def point_in_time_join(
    labels: DataFrame,
    feats: DataFrame,
    keys: Sequence[str],
    label_time: str,
    feat_time: str,
    created: str | None = None,
    ttl: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """For each label, the newest feature row of its entity at or before the label time.

    Of several rows with one feature time the last ``created`` wins. ``ttl`` is an interval such
    as ``365 days``: older features do not count. ``inner`` drops labels without a feature,
    ``left`` keeps them with NULLs. Output: label columns, the feature time as
    ``feature_time`` and the feature columns.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    found = merge_as_of(labels, [Timeline(feats, feat_time, created, ttl)], keys, label_time)
    return found.filter(F.col("feature_time").isNotNull()) if how == "inner" else found


def features_as_of(
    feats: DataFrame, feat_time: str, ts: str, keys: Sequence[str] | None = None, created: str | None = None
) -> DataFrame:
    """Feature rows known at one moment; with ``keys`` only the newest per key."""
    known = feats.filter(F.col(feat_time) <= F.lit(ts).cast(feats.schema[feat_time].dataType))
    if keys is None:
        return known
    return latest_per_key(known, keys, [feat_time, *([created] if created else [])])
