"""Feature views: declaration, historical reads, materialisation, lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import Timeline, merge_as_of, point_in_time_join
from ..operators.dedup import latest_per_key


@dataclass(frozen=True)
class FeatureView:
    """Entity keys, time columns, time to live and typed fields of a feature table."""

    name: str
    keys: tuple[str, ...]
    time: str = "event_timestamp"
    created: str | None = "created_timestamp"
    ttl: str | None = None
    fields: Mapping[str, str] = field(default_factory=dict)

    def select(self, df: DataFrame) -> DataFrame:
        """The view's columns in their declared types; a missing column is an error."""
        wanted = [*self.keys, self.time, *([self.created] if self.created else []), *self.fields]
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name} lacks {', '.join(missing)}")
        return df.select(*[F.col(c).cast(self.fields[c]).alias(c) if c in self.fields else F.col(c) for c in wanted])


CUSTOMER_90D = FeatureView(
    name="customer_90d_stats",
    keys=("customer_id",),
    ttl="365 days",
    fields={
        "f_total_orders_90d": "bigint",
        "f_avg_order_value_90d": "double",
        "f_distinct_categories_90d": "bigint",
    },
)


def export_features(feats: DataFrame, keys: list[str], time: str = "event_timestamp") -> DataFrame:
    """Newest row per key with a created time, ready to be read as a feature view."""
    last = latest_per_key(feats, keys, [time])
    return last.withColumn("created_timestamp", F.col(time))


def historical_features(labels: DataFrame, df: DataFrame, view: FeatureView, label_time: str, how: str = "inner") -> DataFrame:
    """Label rows with the features known at their time and not older than the time to live."""
    return point_in_time_join(
        labels, view.select(df), list(view.keys), label_time, view.time, view.created, view.ttl, how
    )


def unified_features(labels: DataFrame, tables: Sequence[tuple[FeatureView, DataFrame]], label_time: str) -> DataFrame:
    """Label rows with the features of several views, each as of the label time and within its time to live.

    The views must have the same keys. ``<view>_time`` tells when a view's features were taken; a view
    without a valid row gives NULLs. All views are merged in one pass (see :func:`merge_as_of`).
    """
    keys = {view.keys for view, _ in tables}
    if len(keys) != 1:
        raise ValueError("views of one table must have the same keys")
    timelines = [
        Timeline(view.select(df), view.time, view.created, view.ttl, list(view.fields), f"{view.name}_time") for view, df in tables
    ]
    return merge_as_of(labels, timelines, list(keys.pop()), label_time)


def materialize(df: DataFrame, view: FeatureView, start: str, end: str) -> DataFrame:
    """Newest row per entity with event time in ``[start, end]``."""
    kind = df.schema[view.time].dataType
    inside = F.col(view.time).between(F.lit(start).cast(kind), F.lit(end).cast(kind))
    order = [view.time, *([view.created] if view.created else [])]
    return latest_per_key(view.select(df).filter(inside), list(view.keys), order)


def refresh_online(online: DataFrame, fresh: DataFrame, view: FeatureView) -> DataFrame:
    """Online table after a new materialisation; an older row never replaces a newer one."""
    order = [view.time, *([view.created] if view.created else [])]
    return latest_per_key(online.unionByName(fresh), list(view.keys), order)


def online_lookup(latest: DataFrame, wanted: DataFrame, view: FeatureView) -> DataFrame:
    """Feature values for requested entities; an unknown entity gives NULLs."""
    asked = wanted.select(*view.keys).distinct()
    return asked.join(latest.select(*view.keys, *view.fields), list(view.keys), "left")
