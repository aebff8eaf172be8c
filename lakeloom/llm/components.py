"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars: every node with the smallest node it reaches within it."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in list(root)]
    stars = [p for p in pairs if p[0] != p[1]]
    for at in range(0, len(stars), 50_000):
        some = stars[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in some], pa.int64()) for k in (0, 1)], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of ``links (a, b)``.

    Large-star and small-star steps in turn: every node hands its larger neighbours, then its
    smaller ones, to the smallest node around it, until the links are stars. Before each round
    the links of every partition, which has a bounded size, shrink to stars on their own. The number
    of rounds grows with the logarithm of the longest chain. Nodes with very many links are aggregated
    before each shuffle. Each round is a reliable checkpoint in the shared folder. Joins are by
    shuffle, so that the driver holds no table of any round.
    """
    shared_dir(links.sparkSession)
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    while True:
        edges = edges.mapInArrow(_forest, "u bigint, v bigint").checkpoint()
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.hint("shuffle_hash"), "u").filter("v > u and v <> m")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("shuffle_hash"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
