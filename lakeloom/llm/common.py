"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"


def rows_of(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """A small constant table, made by the JVM. There must be a row at least."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def unused(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.array_remove(F.split(text, SPACES), "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` needs it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
