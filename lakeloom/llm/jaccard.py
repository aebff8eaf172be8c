"""Exact Jaccard join of documents on word n-grams, by partitions of the token universe.

Tokens are hashes of word n-grams. Sets go into bands by size. For a band with largest size ``u``, two sets
that reach the similarity, the smaller one of this band, differ in at most ``H`` tokens. The universe
of hashes is cut into segments, the more the larger the band, and the pigeonhole principle names
matching segments:

1. A set is indexed in its own band: the tokens of each segment together give one key. Of ``1 / DELETED``
   of the segments the one-deletion neighbourhood is indexed too: a key for the segment without each of its tokens.
   A segment is worth one credit, since an unequal one takes a difference; with its neighbourhood it is worth two.
   A set also gives keys in every lower band that may hold smaller partners.
2. Cost-based allocation: a set must search with segments worth ``differences + 1`` credits. The bands have
   ``SLACK`` credits more than that. What a segment costs is the number of sets that share its keys, as counted
   in the index. Segments that nobody shares are free, and a set with enough of these has no partner at all;
   the others take the cheapest segments they need.
3. In each key's bucket, searching sets first meet the smallest indexed set. Components of the links so
   found stand for groups of near copies. Only sets of a bucket that are then in different components meet each other,
   block by block. A fingerprint says in how many cells of the universe two sets differ at
   least, which turns most of them away.
4. All pairs are confirmed on the full sets.

Keys and fingerprints can let a pair through in vain, but never hide one. Shingles are compared by
64-bit hashes.

Cases: a text without words has an empty set and is linked with nothing; with fewer words than an n-gram
it has its whole sequence as the one token. Equal sets form a class and take part once. Rows with a NULL
id take no part; their component is NULL. Rows that repeat an id and a text give the same row again; rows
that share an id but not the text are linked each by its own text and get the smallest id of what they
reach. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import shared_dir
from ..sources.writers import staged
from .components import components
from .nodes import Nodes, text_hash
from .shingles import _mixed, shingle_hashes, words
from .verify import confirmed, slices

WORDS = 4
SIMILARITY = Fraction(17, 20)
SLACK = Fraction(6, 5)  # credits of a band per credit that the pigeonhole principle needs
DELETED = 32  # one of so many credits comes from a one-deletion neighbourhood
BLOCK = 512  # sets of a bucket side by side

_STEP = np.uint64(0x9E3779B97F4A7C15)


# --- bands ----------------------------------------------------------------------------------


def differences(n: int, m: int, similarity: Fraction) -> int:
    """Largest symmetric difference of sets of sizes ``n`` and ``m`` that reach the similarity."""
    return int((n + m) * (1 - similarity) / (1 + similarity))


@lru_cache(maxsize=None)
def top(band: int, similarity: Fraction) -> int:
    """Largest size in a band; bands grow by the square of the largest ratio of similar sets."""
    if band == 0:
        return 1
    below = top(band - 1, similarity)
    return max(below + 1, int(below / similarity**2))


@lru_cache(maxsize=1 << 16)
def band_of(n: int, similarity: Fraction) -> int:
    band = 0
    while top(band, similarity) < n:
        band += 1
    return band


@lru_cache(maxsize=None)
def plan(band: int, similarity: Fraction) -> tuple[int, int, int]:
    """Segments, those of them with a neighbourhood (the first ones), and credits of a band."""
    u = top(band, similarity)
    need = differences(u, int(u / similarity), similarity) + 1
    credits = -int(-need * SLACK // 1)
    deleted = need // DELETED
    return credits - deleted, deleted, credits


@lru_cache(maxsize=256)
def _bounds(segments: int) -> np.ndarray:
    return np.array([(k << 64) // segments for k in range(segments)], dtype=np.uint64)


def keys_of(h: np.ndarray, band: int, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Key hashes and segment numbers of a sorted set; the neighbourhoods follow the segments."""
    segments, deleted, _ = plan(band, similarity)
    starts = np.append(np.searchsorted(h, _bounds(segments)), len(h))
    spread = _mixed(h + _STEP)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
    numbers = np.arange(segments, dtype=np.uint64)
    label = _mixed(numbers * _STEP + np.uint64(band + 1))
    whole = sums[starts[1:]] - sums[starts[:-1]]
    keys, of = _mixed(whole + label), np.arange(segments)
    if deleted:
        inside = slice(0, starts[deleted])  # tokens of the first segments come first
        mine = np.searchsorted(starts, np.arange(starts[deleted]), side="right") - 1
        less = _mixed(whole[mine] - spread[inside] + label[mine])
        keys, of = np.concatenate([keys, less]), np.concatenate([of, mine])
    return keys, of


def spare_credits(n: int, band: int, similarity: Fraction) -> int:
    """Credits a set may leave unused when it looks for smaller or equal sets of a band."""
    smaller = min(n, top(band, similarity))
    return plan(band, similarity)[2] - differences(n, smaller, similarity) - 1


def fingerprint(h: np.ndarray, cells: int) -> np.ndarray:
    """One byte per cell of the universe, a power of two of them; unequal bytes mean unequal tokens."""
    shift = np.uint64(64 - cells.bit_length() + 1)
    at = (h >> shift).astype(np.int64) if cells > 1 else np.zeros(len(h), np.int64)
    starts = np.searchsorted(at, np.arange(cells + 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(h + _STEP), dtype=np.uint64)])
    return (_mixed(sums[starts[1:]] - sums[starts[:-1]]) >> np.uint64(56)).astype(np.uint8)


def _cells(band: int, similarity: Fraction) -> int:
    return 1 << max(0, top(band, similarity).bit_length() - 1)


# --- index ----------------------------------------------------------------------------------


def _classes(size: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                classes, sizes = [], []
                for text in part.column(2).to_pylist():
                    h = shingle_hashes(words(text), size)
                    classes.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                    sizes.append(len(h))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(classes, pa.binary()), pa.array(sizes, pa.int64())], ["id", "th", "class", "n"])

    return of


def _index(size: int, similarity: Fraction):
    """Rows (key, node, info): ``info`` holds spare credits, segment, credits and whether the band is a lower one."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys, nodes, infos = [], [], []
                for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    h = shingle_hashes(words(text), size)
                    if not len(h):
                        continue
                    own = band_of(len(h), similarity)
                    least = -int(-len(h) * similarity // 1)
                    for band in range(band_of(least, similarity), own + 1):
                        k, segment = keys_of(h, band, similarity)
                        double = segment < plan(band, similarity)[1]
                        info = (spare_credits(len(h), band, similarity) << 32) + (segment.astype(np.int64) << 2) + 2 * double + (band != own)
                        keys.append(k.view(np.int64))
                        infos.append(info.astype(np.int64))
                        nodes.append(np.full(len(k), node, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, infos)], ["key", "node", "info"])

    return of


def searched(keys: DataFrame) -> DataFrame:
    """Shared keys with ``own`` (indexed), ``leader`` (smallest indexed set) and ``chosen`` (searched by this set)."""
    lower = F.col("info").bitwiseAND(F.lit(1)) == 1
    dealt = keys.repartition("key")  # one exchange for both sides below
    shared = dealt.groupBy("key").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("sets"),
        F.min(F.when(~lower, F.col("node"))).alias("leader"),
    )
    shared = shared.filter("lo < hi AND leader IS NOT NULL").select("key", "sets", "leader")
    found = dealt.join(shared.hint("shuffle_hash"), "key").withColumn("own", ~lower)
    # The cheapest segments first, until what is left unused is no more than a set may leave.
    segment = Window.partitionBy("node", "info")
    worth = F.when(F.col("info").bitwiseAND(F.lit(2)) == 2, 2).otherwise(1)
    first = F.row_number().over(segment.orderBy("key")) == 1
    priced = found.withColumn("cost", F.sum("sets").over(segment)).withColumn("credit", F.when(first, worth).otherwise(0))
    search = Window.partitionBy("node", "own")
    so_far = search.orderBy("cost", "info", "key").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("credit").over(so_far) - worth
    needed = F.sum("credit").over(search) - F.shiftright("info", 32)
    return priced.select("key", "node", "own", "leader", (before < needed).alias("chosen"))


# --- buckets with several components -------------------------------------------------------------


def _meeting(similarity: Fraction, least_rows: int = 64):
    """Blocks of rows (block, searching, root, node, n, print) in order to pairs that may be similar."""
    p, q = similarity.numerator, similarity.denominator

    def pairs(rows: list[tuple]) -> list[tuple[int, int]]:
        indexed = [r for r in rows if not r[1]]
        if not indexed:
            return []
        node, root, n = (np.array([r[k] for r in indexed], dtype=np.int64) for k in (3, 2, 4))
        prints = np.frombuffer(b"".join(r[5] for r in indexed), np.uint8).reshape(len(indexed), -1)
        found = []
        for r in rows:
            if r[1]:
                fits = (root != r[2]) & (np.minimum(n, r[4]) * q >= np.maximum(n, r[4]) * p)
                at = np.flatnonzero(fits)
                if len(at):
                    apart = np.count_nonzero(prints[at] != np.frombuffer(r[5], np.uint8), axis=1)
                    near = at[apart * (p + q) <= (n[at] + r[4]) * (q - p)]
                    found += [(min(r[3], o), max(r[3], o)) for o in node[near].tolist()]
        return found

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def made(found):
            found = sorted(set(found))
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if row[0] != block:
                        if found := pairs(held):
                            yield made(found)
                        block, held = row[0], []
                    held.append(row)
        if found := pairs(held):
            yield made(found)

    return meet


def _prints(size: int, similarity: Fraction):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    h = shingle_hashes(words(text), size)
                    own = band_of(len(h), similarity)
                    least = -int(-len(h) * similarity // 1)
                    for band in range(band_of(least, similarity), own + 1):
                        out.append((node, band == own, len(h), fingerprint(h, _cells(band, similarity)).tobytes()))
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], ["node", "own", "n", "print"])

    return of


def _rest(found: DataFrame, labels: DataFrame, texts, size: int, similarity: Fraction) -> DataFrame:
    """Pairs that may be similar in buckets of several components."""
    rows = found.join(labels, "node", "left").select("key", "node", "own", "chosen", F.coalesce("root", "node").alias("root"))
    buckets = rows.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count_if("chosen").alias("asks"), F.count_if("own").alias("held"),
    )
    blocks = lambda c: F.ceil(F.col(c) / float(BLOCK)).cast("int")
    buckets = buckets.filter("lo < hi AND asks > 0").select("key", blocks("asks").alias("ask_ways"), blocks("held").alias("held_ways"))
    open_rows = rows.filter("own OR chosen").join(buckets, "key").checkpoint()
    prints = texts(open_rows.select("node").distinct()).mapInArrow(_prints(size, similarity), "node bigint, own boolean, n bigint, print binary")
    full = open_rows.join(prints, ["node", "own"])
    mine = lambda ways: F.pmod(F.xxhash64("node"), F.col(ways)).cast("int")
    each = lambda ways: F.explode(F.sequence(F.lit(0), F.col(ways) - 1))
    cols = ["root", "node", "n", "print"]
    asking = full.filter("chosen").select("key", mine("ask_ways").alias("i"), each("held_ways").alias("j"), F.lit(True).alias("asking"), *cols)
    held = full.filter("own").select("key", each("ask_ways").alias("i"), mine("held_ways").alias("j"), F.lit(False).alias("asking"), *cols)
    dealt = asking.unionByName(held).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    block = F.struct("key", "i", "j")
    return dealt.select(block.alias("block"), "asking", *cols).mapInArrow(_meeting(similarity), "a bigint, b bigint").distinct()


# --- the join -------------------------------------------------------------------------------


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, similarity: Fraction = SIMILARITY
) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` for every row of ``docs``."""
    shared_dir(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    signed = staged(named.mapInArrow(_classes(size), "id bigint, th bigint, class binary, n bigint"), "classes")
    nodes = Nodes.of(named, signed.filter("id IS NOT NULL AND n > 0"))

    def check(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().checkpoint()
        return confirmed(pairs, nodes.texts(wanted), size, similarity)

    sizes = nodes.sets.join(signed.select("class", "n").distinct(), "class").select("node", "n")
    found = searched(nodes.rows().mapInArrow(_index(size, similarity), "key bigint, node bigint, info bigint"))
    found = staged(found, "shared-segments")
    p, q = similarity.numerator, similarity.denominator
    first = found.filter("chosen AND node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    first = first.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("m")), "b").join(sizes.withColumnRenamed("node", "a"), "a")
    first = first.filter(F.least("n", "m") * q >= F.greatest("n", "m") * p).select("a", "b").checkpoint()
    labels = components(check(first)).checkpoint()
    met = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _rest(found, labels, nodes.texts, size, similarity).join(met, ["a", "b"], "left_anti").checkpoint()
    if not more.isEmpty():
        known = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
        labels = components(known.unionByName(check(more))).checkpoint()

    reached = nodes.components(labels).select("class", "component")
    judged = spread_join(signed.select("id", "class", "n"), reached, ["class"])
    reach = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("id"))
    return judged.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), reach.alias("component_id"))
