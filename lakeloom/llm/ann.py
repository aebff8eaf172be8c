"""Nearest neighbours by inner product over an inverted multi-index.

Vectors are cut into two halves and each half is quantised with its own codebook, so a cell of the
index is a pair of centroids. A query adds up the products of its halves with the centroids and
visits pairs in falling order of the sum, with a heap over the two sorted lists, until the visited
cells hold a share of all entries. The entries of these cells are reranked by the exact product.
The visited cells are those whose sum is at least the last one, so this sum is all a query sends.
The share decides the recall: vectors spread evenly over all directions, the hardest case, need
more than half of all entries for a recall above 0.9, clustered ones far fewer.

Codebooks are fitted on at most ``SAMPLE`` vectors, those with the smallest hashes of their ids;
every vector is indexed. Cells are packed into blocks of about ``BLOCK`` entries, a cell with more is
spread over several blocks, and queries meet the entries block by block.

Cases: vectors that are NULL, all zero, of another length than most, or that hold NULL or
non-finite components take no part, neither do rows with a NULL id. A row is no candidate for a
query of the same id. Repeated rows count one by one. Equal scores go to the smaller id. With fewer than
``k`` candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.writers import staged

SAMPLE = 20_000  # vectors on which the codebooks are fitted
SHARE = 0.7  # of all entries that a query reranks; sets the recall
PER_CELL = 2  # entries of a cell on average, as long as the codebooks may grow
CENTROIDS = 512  # of a codebook at most
BLOCK = 4096  # entries in a block
QUERIES = 1024  # queries that meet a block at a time
ROUNDS = 12  # of k-means


def usable(vector: Column, dim: int) -> Column:
    return (
        vector.isNotNull()
        & (F.size(vector) == dim)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def k_means(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids by Lloyd's rounds, from a fixed start. Fewer points than ``k`` are their own centroids."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= k:
        return distinct
    centroids = distinct[np.random.RandomState(7).permutation(len(distinct))[:k]]
    for _ in range(ROUNDS):
        near = nearest(points, centroids)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    found = []
    for at in range(0, len(points), 4096):
        some = points[at : at + 4096]
        found.append(np.argmin((centroids**2).sum(1) - 2 * some @ centroids.T, axis=1))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def visited(left: np.ndarray, right: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, float]:
    """Cells in falling order of ``left[i] + right[j]`` until they hold ``least`` entries, or all cells.

    Also the sum of the last one. ``counts[i, j]`` has the entries of a cell; empty cells are passed but not returned.
    """
    a, b = np.argsort(-left, kind="stable").tolist(), np.argsort(-right, kind="stable").tolist()
    x, y = left[a].tolist(), right[b].tolist()
    reach = [0] * len(a)  # of each row, the columns that were taken
    heap = [(-(x[0] + y[0]), 0)]
    cells, held, width, last = [], 0, len(b), 0.0
    while heap and held < least:
        # Each row holds one place in the heap; the next row enters when this one takes its first column.
        last, i = heapq.heappop(heap)
        j = reach[i]
        n = counts[a[i]][b[j]]
        if n:
            cells.append(a[i] * width + b[j])
            held += n
        reach[i] = j + 1
        if j + 1 < width:
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1))
    return np.array(cells, dtype=np.int64), -last


def _matrix(vectors: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block of every cell and the number of blocks its entries are spread over."""
    ways = np.maximum(1, -(-counts // BLOCK))
    first = np.zeros(len(counts), dtype=np.int64)
    block, held = 0, 0
    for cell in np.flatnonzero(counts).tolist():
        n = int(counts[cell])
        if held and held + n > BLOCK:
            block, held = block + 1, 0
        first[cell] = block
        if ways[cell] > 1:
            block, held = block + int(ways[cell]), 0
        else:
            held += n
    return first, ways


def search(
    vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", share: float = SHARE
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best found for every row where ``queries`` holds."""
    spark = vectors.sparkSession
    shared_dir(spark)
    named = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), queries.alias("asks")
    ).filter("id IS NOT NULL")
    result = "query_id bigint, vec_id bigint, score double"
    dim = named.agg(F.mode(F.when(F.size("v") > 0, F.size("v")))).first()[0]
    good = named.filter(usable(F.col("v"), dim or 0))
    sample = good.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).toArrow()
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    total = good.count()
    half = dim // 2
    points = _matrix(sample["v"], dim)
    size = int(min(CENTROIDS, max(2, 2 ** round(np.log2(max(4.0, total / PER_CELL)) / 2))))
    books = k_means(points[:, :half], size), k_means(points[:, half:], size)
    width = len(books[1])
    shared = spark.sparkContext.broadcast(books)  # two codebooks of bounded size

    def cells_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one, two = shared.value
        for batch in batches:
            x = _matrix(batch, dim)
            yield pa.array(nearest(x[:, :half], one) * width + nearest(x[:, half:], two), pa.int64())

    entries = staged(good.withColumn("cell", F.arrow_udf(cells_of, "bigint")("v")), "entries")
    counts = np.zeros(len(books[0]) * width, dtype=np.int64)
    for cell, n in entries.groupBy("cell").count().collect():  # at most one row per pair of centroids
        counts[cell] = n
    first, ways = _blocks(counts)
    layout = spark.sparkContext.broadcast((counts.reshape(-1, width).tolist(), first, ways))
    least = max(int(np.ceil(share * total)), k + 1)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and block it visits, with the sum that a visited cell reaches."""
        one, two = shared.value
        table, start, spread = layout.value
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            for i, (query, left, right) in enumerate(zip(batch.column(0).to_pylist(), x[:, :half] @ one.T, x[:, half:] @ two.T)):
                cells, floor = visited(left, right, table, least)
                wide = cells[spread[cells] > 1]
                more = [np.arange(start[c], start[c] + spread[c]) for c in wide.tolist()]
                blocks = np.unique(np.concatenate([start[cells], *more]))
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks),
                        pa.array([query] * n, pa.int64()),
                        pa.array([x[i]] * n, pa.list_(pa.float64())),
                        pa.array([floor] * n, pa.float64()),
                    ],
                    ["block", "id", "v", "floor"],
                )

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, start, spread = layout.value
        for batch in batches:
            ids, cells = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            block = start[cells] + (mixed % spread[cells].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns], ["block", "id", "v", "cell"])

    groups = -(-entries.filter("asks").count() // QUERIES)
    asks = entries.filter("asks").select("id", "v").mapInArrow(asked, "block bigint, id bigint, v array<double>, floor double")
    asks = asks.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(1, groups))))
    held = entries.select("id", "v", "cell").mapInArrow(dealt, "block bigint, id bigint, v array<double>, cell bigint")
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(1, groups) - 1)).cast("array<bigint>")))

    def rerank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found_q, found_v, found_s = [], [], []
        if len(queries) and len(rows):
            ids = rows["id"].to_numpy()
            x = _matrix(rows["v"], dim)
            codes, local = np.unique(rows["cell"].to_numpy(), return_inverse=True)
            q = _matrix(queries["v"], dim)
            one, two = shared.value
            sums = (q[:, :half] @ one.T)[:, codes // width] + (q[:, half:] @ two.T)[:, codes % width]
            seen = sums >= queries["floor"].to_numpy()[:, None] - 1e-12  # products may differ in the last bits
            for i, query in enumerate(queries["id"].to_pylist()):
                fits = np.flatnonzero(seen[i][local] & (ids != query))
                rough = x[fits] @ q[i]
                if len(fits) > k:
                    edge = np.partition(rough, len(rough) - k)[len(rough) - k]
                    near = rough >= edge - 1e-9 * max(1.0, abs(edge))
                    fits = fits[near]
                score = (x[fits] * q[i]).sum(axis=1)  # one order of addition for every row
                best = np.lexsort((ids[fits], -score))[:k]
                found_q.append(np.full(len(best), query, dtype=np.int64))
                found_v.append(ids[fits][best])
                found_s.append(score[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table(
            {"query_id": join(found_q, np.int64), "vec_id": join(found_v, np.int64), "score": join(found_s, np.float64)}
        )

    near = asks.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInArrow(rerank, result)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.select("query_id", place.cast("int").alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
