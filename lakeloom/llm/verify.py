"""Pairs of documents confirmed on their full shingle sets, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, spread_join
from .shingles import shingle_hashes, words

BLOCK = 256  # partners of one document that are looked at together
SLICE_BYTES = 1 << 20  # text turned into Python objects at a time


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of the string column each; a longer text is alone."""
    marks = np.cumsum(_lengths(batch.column(column))) // limit
    cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: Fraction, block: int = BLOCK) -> DataFrame:
    """Those of ``pairs (a, b)`` whose sets of ``size``-word shingles reach the similarity.

    ``texts`` has ``node`` and ``text``, one row per node. The partners of one ``a`` are dealt into blocks,
    and its text is moved once per block: no task gets all partners of a node, no row holds two texts.
    """
    p, q = similarity.numerator, similarity.denominator
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / float(block)).cast("int").alias("ways")).filter("ways > 1")
    dealt = spread_join(pairs, many, ["a"]).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.coalesce("ways", F.lit(1))).cast("int").alias("block")
    )
    dealt = dealt.checkpoint()
    (hot,) = hot_keys(dealt, [["b"]])
    right = spread_join(dealt, texts.withColumnRenamed("node", "b"), ["b"], "inner", hot)
    left = dealt.select("a", "block").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    nobody = F.lit(None).cast("bigint")
    rows = left.select("a", "block", nobody.alias("b"), "text").unionByName(right.select("a", "block", "b", "text"))
    rows = rows.repartition("a", "block").sortWithinPartitions("a", "block", F.asc_nulls_first("b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, 2):
                found = []
                for a, b, text in zip(*(c.to_pylist() for c in part.columns)):
                    y = shingle_hashes(words(text), size)
                    if b is None:
                        x = y
                        continue
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if q * both >= p * (len(x) + len(y) - both):
                        found.append((a, b))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.select("a", "b", "text").mapInArrow(check, "a bigint, b bigint")
