"""Joins that survive hot keys and NULL keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    CharType,
    DataType,
    DateType,
    DayTimeIntervalType,
    DoubleType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
    YearMonthIntervalType,
)

from ..functions import exact_sum, exact_type, whole_cents

HOT_SHARE = 0.01  # a key is hot from this share of all rows on
BROADCAST_BYTES = 10 * 1024 * 1024  # a side up to this size is sent to every executor


def hot_keys(
    df: DataFrame, groups: Sequence[Sequence[str]], share: float = HOT_SHARE
) -> list[dict[int | None, int]]:
    """For each key (a list of columns), the hash of every hot value and its number of splits.

    ``None`` stands for rows whose key is NULL. One pass over the key columns with a
    frequent-items sketch. At most ``1/share`` values per key can be hot, so what comes back to
    the driver has a fixed bound. A value is split into as many parts as its share of the shuffle
    partitions. The sketch only steers the spreading: a value it reports or misses changes the
    balance, never the rows.
    """
    keep = int(1 / share)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, cols in enumerate(groups):
        key = F.when(_all_set(cols), F.xxhash64(*cols))
        aggs.append(F.call_function("approx_top_k", key, F.lit(keep), F.lit(keep * 100)).alias(f"k{i}"))
        aggs.append(F.count_if(key.isNull()).alias(f"nulls{i}"))
    row = df.select(*{c for cols in groups for c in cols}).agg(*aggs).first()
    hot = []
    for i in range(len(groups)):
        sizes = {entry["item"]: entry["count"] for entry in row[f"k{i}"] or []}
        sizes[None] = row[f"nulls{i}"]
        hot.append(
            {
                item: max(2, -(-count * parts // row["n"]))
                for item, count in sizes.items()
                if count and count >= share * row["n"]
            }
        )
    return hot


def _all_set(cols: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return known


def _extra_bytes(c: Column, kind: DataType) -> Column | None:
    """Bytes of a value beyond 8, or None for types of fixed width."""
    if isinstance(kind, (StringType, BinaryType, CharType, VarcharType)):
        return F.octet_length(c)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
        return 8 * F.greatest(F.size(c), F.lit(0))
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.octet_length(F.to_json(F.struct(c.alias("v"))))
    if isinstance(kind, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType, NullType, DayTimeIntervalType, YearMonthIntervalType)):
        return None
    return F.lit(BROADCAST_BYTES)  # of an unknown size: a few rows already count as too big


def small_ones(frames: Sequence[DataFrame], limit: int = BROADCAST_BYTES) -> list[bool]:
    """Which frames are at most ``limit`` bytes, measured in one job over all of them.

    Every column counts 8 bytes a row, text and binary columns also their length, nested ones the
    length of their elements or of their JSON form. A frame of fixed-width columns is only counted,
    which a plain Parquet table answers from its file footers.
    """
    sizes = None
    for i, df in enumerate(frames):
        size = F.count(F.lit(1)) * 8 * len(df.columns)
        for f in df.schema.fields:
            extra = _extra_bytes(F.col(f"`{f.name}`"), f.dataType)
            if extra is not None:
                size = size + F.coalesce(F.sum(extra), F.lit(0))
        one = df.agg(F.lit(i).alias("i"), size.alias("bytes"))
        sizes = one if sizes is None else sizes.unionByName(one)
    found = {row["i"]: row["bytes"] for row in sizes.collect()} if frames else {}  # one row per frame
    return [found[i] <= limit for i in range(len(frames))]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot: Mapping[int | None, int] | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join of many ``left`` rows to a ``right`` side that is unique on ``on``.

    A right side of at most ``limit`` bytes is broadcast and ``left`` stays where it is. A bigger
    one is joined by shuffle: hot left keys are salted and only their right rows are repeated,
    once per salt, at most (shuffle partitions + number of hot keys) extra right rows in all.
    Left rows with a NULL key match nothing, so many of them are salted too and do not pile up in
    one task. Without hot keys this is a plain join. With ``hot`` given, neither size nor keys are
    looked at.

    The salt is made of a hash of the row, which is the same after a retry, and the number of the
    task's partition, which is too: so exact copies of one row also end in different tasks.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    out = left.columns + [c for c in right.columns if c not in on]
    if hot is None:
        (small,) = small_ones([right], limit)
        if small:
            return left.join(F.broadcast(right), list(on), how).select(*out)
        (hot,) = hot_keys(left, [list(on)])
    named = {item: splits for item, splits in hot.items() if item is not None}
    if not named and (how == "inner" or None not in hot):
        return left.join(right, list(on), how).select(*out)
    splits = right_splits = F.lit(1)
    if named:
        table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
        # Hashes depend on the type, so right keys are hashed as the left type (an INT and a BIGINT may join).
        alike = [F.col(c).try_cast(left.schema[c].dataType) for c in on]
        splits = F.coalesce(F.element_at(table, F.xxhash64(*on)), F.lit(1))
        right_splits = F.coalesce(F.element_at(table, F.xxhash64(*alike)), F.lit(1))
    ways = F.when(_all_set(on), splits).otherwise(F.lit(hot.get(None, 1)))
    salt = F.pmod(F.pmod(F.xxhash64(*left.columns), ways) + F.spark_partition_id(), ways).cast("int")
    salted_left = left.withColumn("_salt", salt)
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), right_splits - 1)))
    return salted_left.join(salted_right, [*on, "_salt"], how).select(*out)


def star_join(
    fact: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, Sequence[str]]],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach columns of several dimensions: ``(dimension, key, columns)`` each, all joined ``how``."""
    return chain_join(fact, [(dim.select(key, *cols), key, how) for dim, key, cols in lookups], limit)


def chain_join(fact: DataFrame, joins: Sequence[tuple[DataFrame, str, str]], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join sides that are unique on their key to ``fact``, one after the other: ``(side, key, how)`` each.

    One job measures the sides; small ones are broadcast. The hot keys of all others are found in
    one pass over ``fact`` as it is given, so no join is run to find the keys of the next one. The
    keys must be columns of ``fact``.
    """
    small = small_ones([side for side, _, _ in joins], limit)
    big_keys = [key for (_, key, _), s in zip(joins, small) if not s]
    hot = iter(hot_keys(fact, [[k] for k in big_keys]) if big_keys else [])
    for (side, key, how), is_small in zip(joins, small):
        if is_small:
            out = fact.columns + [c for c in side.columns if c != key]
            fact = fact.join(F.broadcast(side), key, how).select(*out)
        else:
            fact = spread_join(fact, side, [key], how, next(hot))
    return fact


def lookup(fact: DataFrame, dim: DataFrame, on: str, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Attach ``cols`` of one dimension."""
    return star_join(fact, [(dim, on, cols)], how)


def all_whole(items: DataFrame, amount_col: str) -> bool:
    """Whether the amounts are DOUBLE and each one :func:`whole_cents` or NULL. One pass over the column of a stored table."""
    if not isinstance(items.schema[amount_col].dataType, DoubleType):
        return False
    return items.agg(F.bool_and(whole_cents(amount_col))).first()[0] is not False


def order_totals(items: DataFrame, key: str, amount_col: str, places: int = 1, whole: bool = False) -> DataFrame:
    """Line count and summed amount per order; the lines of one order shrink before the shuffle.

    ``whole`` says that :func:`all_whole` holds: the cents then add up as BIGINT, to the same totals in less time.
    """
    if whole:
        n = F.sum(F.floor(F.col(amount_col) * 100 + 0.5).cast("bigint"))
        total = F.round(n.cast("decimal(20,0)") * F.lit(Decimal("0.01")), places).cast("double")
    else:
        total = exact_sum(amount_col, places, exact_type(items, amount_col))
    return items.groupBy(key).agg(F.count(F.lit(1)).alias("item_count"), total.alias("order_net_amount"))


def zero_filled_totals(base: DataFrame, items: DataFrame, key: str, amount_col: str, out: str) -> DataFrame:
    """Summed amount per base row, 0 where there are no lines."""
    totals = items.groupBy(key).agg(exact_sum(amount_col, kind=exact_type(items, amount_col)).alias(out))
    return base.join(totals, key, "left").fillna({out: 0.0})


def orphans(fact: DataFrame, source: DataFrame, fact_id: str, key: str, source_ref: str) -> DataFrame:
    """Fact rows without a dimension key although their source row names one.

    A NULL reference in the source (a guest order) is not an orphan.
    """
    named = source.filter(F.col(source_ref).isNotNull()).select(fact_id)
    return fact.filter(F.col(key).isNull()).join(named, fact_id, "left_semi")


def unmatched(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Fact rows whose non-NULL reference has no row in ``dim``; the reference comes first."""
    listed = dim.select(on).distinct().withColumn("_listed", F.lit(True))
    named = fact.filter(F.col(on).isNotNull())
    # The dimension is measured as it is: its distinct keys are computed by the join only.
    (small,) = small_ones([dim.select(on)])
    if small:
        found = named.join(F.broadcast(listed), on, "left")
    else:
        found = spread_join(named, listed, [on], hot=hot_keys(named, [[on]])[0])
    return found.filter(F.col("_listed").isNull()).select(on, *[c for c in fact.columns if c != on])


def keys_without_rows(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``base`` that ``other`` lacks.

    One aggregation over both sides: repeated keys shrink before the shuffle.
    """
    sides = base.select(key, F.lit(0).alias("_side")).unionByName(other.select(key, F.lit(1).alias("_side")))
    return sides.groupBy(key).agg(F.max("_side").alias("_side")).filter("_side = 0").select(key)
