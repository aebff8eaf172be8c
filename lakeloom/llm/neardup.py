"""Near-duplicate documents by b-bit MinHash.

1. Each text becomes its set of word shingles, ``PERMUTATIONS`` minima over the set, keys of the
   bands of minima, and a signature: the low ``BITS`` bits of every minimum, packed into integers.
   Texts with the same words form a class and go on as one representative.
2. Documents that share a band are candidates. In each band bucket every member meets the smallest
   one first, which is enough for groups of copies. Members of a bucket that are then still in
   different components are looked at again: one with too many shingles that no other such member
   has cannot be similar to any of them, which settles the outliers of large groups. The rest meet in blocks.
3. A candidate pair stays if the similarity estimated from equal signature parts, corrected for
   chance collisions, is at most ``MARGIN`` below the threshold. The survivors are confirmed on
   the full shingle sets, and components are built from confirmed links.

A pair at the threshold shares no band with probability ``(1 - 0.75^4)^32``, five in a million, and
the estimate rejects it about as rarely.

Cases: a document without words has no shingles and stays alone; one with fewer words than a
shingle has its whole sequence as the one shingle. Rows with a NULL id take no part: their root is
NULL and they are kept. Rows that repeat an id and a text give the same row again; rows that share
an id but not the text are linked each by its own text and get the smallest id that they reach. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import shared_dir
from ..sources.writers import staged
from .common import unused
from .components import components
from .jaccard import fingerprint
from .nodes import Nodes, text_hash
from .shingles import _RNG, _STEP, WORDS, _mixed, shingle_hashes, words
from .verify import confirmed, slices

SIMILARITY = Fraction(3, 4)
BANDS, ROWS, BITS = 32, 4, 2
PERMUTATIONS = BANDS * ROWS
MARGIN = 0.22  # nearly five standard errors of the estimate at the threshold
BLOCK = 512  # members of a bucket side by side in one block
CELLS = 1 << 14  # of a fingerprint, at most
Texts = Callable[[DataFrame], DataFrame]  # texts of the given nodes

_XOR = _RNG.randint(0, 2**63, PERMUTATIONS).astype(np.uint64)[:, None]
_ODD = (_RNG.randint(0, 2**63, PERMUTATIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        low = np.minimum(low, ((hashes[None, at : at + 2048] ^ _XOR) * _ODD).min(axis=1))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        h = _mixed(h * np.uint64(_STEP) + rows[:, k])
    return h.view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of the minima, packed into 64-bit integers."""
    per = 64 // BITS
    parts = (low & np.uint64((1 << BITS) - 1)).reshape(-1, per) << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(parts, axis=1).view(np.int64)


SIGNATURE = [f"s{i}" for i in range(PERMUTATIONS * BITS // 64)]
_LOWEST = sum(1 << (BITS * i) for i in range(64 // BITS))  # the lowest bit of every packed part


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 2):
            classes, sizes, bands, signs = [], [], [], []
            for text in batch.column(2).to_pylist():
                tokens = words(text)
                hashes = shingle_hashes(tokens)
                classes.append(hashlib.blake2b(b" ".join(tokens), digest_size=16).digest())
                sizes.append(len(hashes))
                low = minima(hashes)
                bands.append(band_keys(low) if len(hashes) else None)
                signs.append(packed(low))
            table = np.array(signs, dtype=np.int64).reshape(len(signs), len(SIGNATURE))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
                + [pa.array(table[:, i]) for i in range(len(SIGNATURE))],
                ["id", "th", "class", "n", "bands", *SIGNATURE],
            )


def signatures(named: DataFrame) -> DataFrame:
    """``id``, ``th``, ``class``, number of shingles ``n``, ``bands`` and packed signature of every row of ``named (id, th, text)``."""
    schema = "id bigint, th bigint, class binary, n bigint, bands array<bigint>, " + ", ".join(f"{s} bigint" for s in SIGNATURE)
    return named.select("id", "th", "text").mapInArrow(_signatures, schema)


def estimated(left: str, right: str) -> Column:
    """Similarity from two packed signatures, corrected for parts that are equal by chance."""
    differ = F.lit(0)
    for s in SIGNATURE:
        x = F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))
        any_bit = x
        for b in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, b))
        differ = differ + F.bit_count(any_bit.bitwiseAND(F.lit(_LOWEST).cast("bigint")))
    chance = 2.0**-BITS
    return ((1.0 - differ / float(PERMUTATIONS)) - chance) / (1.0 - chance)


def _near(n: Column, m: Column, similarity: Fraction) -> Column:
    """Whether sets of these sizes can be so similar at all."""
    p, q = similarity.numerator, similarity.denominator
    return F.least(n, m) * q >= F.greatest(n, m) * p


def promising(pairs: DataFrame, signs: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs ``(a, b)`` whose estimate is not clearly below the similarity."""
    signs = signs.select("rep", F.struct("n", *SIGNATURE).alias("sign"))
    left = signs.select(F.col("rep").alias("a"), F.col("sign").alias("x"))
    right = signs.select(F.col("rep").alias("b"), F.col("sign").alias("y"))
    found = pairs.join(right, "b").join(left, "a")
    return found.filter(
        _near(F.col("x.n"), F.col("y.n"), similarity) & (estimated("x", "y") >= float(similarity) - MARGIN)
    ).select("a", "b")


def supported(ids: DataFrame, texts: Texts, similarity: Fraction) -> DataFrame:
    """``rep`` of those of ``ids (node)`` that can be similar to another one at all.

    A shared shingle is in two sets. So a document is out if too few of its shingles are in
    another set of the table. Counted exactly, with one row per shingle, combined before the shuffle.
    """
    p, q = similarity.numerator, similarity.denominator

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    h = shingle_hashes(words(text)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), id_)), pa.array(np.full(len(h), len(h)))], ["h", "id", "n"])

    each = texts(ids).select("node", "text").mapInArrow(sets, "h bigint, id bigint, n bigint")
    # A shingle of one set only has that set's id and size as its minima.
    held = each.groupBy("h").agg(F.count(F.lit(1)).alias("sets"), F.min("id").alias("node"), F.min("n").alias("n"))
    alone = held.filter("sets = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"), F.min("n").alias("n"))
    out = alone.filter((F.col("n") - F.col("alone")) * q < F.col("n") * p)
    return ids.join(out, "node", "left_anti").select(F.col("node").alias("rep"))


def _open(placed: DataFrame) -> DataFrame:
    """Members ``placed (key, rep, root)`` of buckets that hold several components."""
    keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    return placed.join(keys, "key")


def prints(leveled: DataFrame, step: float) -> DataFrame:
    """``rep``, ``level`` and ``print`` of ``leveled (rep, level, text)``, for its level and the one above.

    The fingerprint has one byte per cell of the shingle hashes. Unequal bytes mean a shingle that only one of the
    two sets has, so sets differ by at least as many shingles as cells. There are two to four cells for
    each shingle of the level, at most ``CELLS``.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                out = []
                for rep, level, text in zip(*(c.to_pylist() for c in part.columns)):
                    h = shingle_hashes(words(text))
                    for above in (level, level + 1):
                        cells = min(CELLS, 2 << int(np.exp(step * (above + 1))).bit_length())
                        out.append((rep, above, fingerprint(h, cells).tobytes()))
                kinds = (pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], ["rep", "level", "print"])

    return leveled.select("rep", "level", "text").mapInArrow(of, "rep bigint, level int, print binary")


def _rest(buckets: DataFrame, labels: DataFrame, signs: DataFrame, texts: Texts, similarity: Fraction) -> DataFrame:
    """Promising pairs in buckets that hold members of several components, apart from pairs with
    the smallest member, which have been looked at.

    Members are dealt by the logarithm of their set size, since similar sets have sizes within one
    step of each other, and large levels into blocks. Members meet within their level and with the
    level below, block by block, so no task holds a whole bucket. A pair leaves its block only if the
    fingerprints do not rule it out, which they do exactly; the estimate alone lets nearly all pairs of a
    large group through whose texts are similar, but too little.
    """
    placed = buckets.filter("rep <> leader").join(labels, F.col("rep") == F.col("node"), "left")
    placed = _open(placed.select("key", "rep", F.coalesce("root", "rep").alias("root"))).checkpoint()
    able = supported(placed.select(F.col("rep").alias("node")).distinct().checkpoint(), texts, similarity)
    placed = _open(placed.join(able, "rep", "left_semi"))
    step = float(np.log(1 / float(similarity))) + 1e-9
    members = (
        placed.join(signs.select("rep", "n", *SIGNATURE), "rep")
        .withColumn("level", F.floor(F.ln("n") / step).cast("int"))
        .checkpoint()  # read by every kind of block below
    )
    sized = members.select(F.col("rep").alias("node"), "level").distinct().checkpoint()
    leveled = texts(sized.select("node")).join(sized, "node").select(F.col("node").alias("rep"), "level", "text")
    marks = prints(leveled, step).checkpoint()
    ways = members.groupBy("key", "level").agg(F.ceil(F.count(F.lit(1)) / float(BLOCK)).cast("int").alias("ways"))
    ways = ways.checkpoint()
    mine = F.pmod(F.xxhash64("rep"), F.col("ways")).cast("int")
    # Within a level: block (i, j) with i <= j. With the level below: every own block with every lower one.
    own = members.join(ways, ["key", "level"]).withColumn("i", mine)
    lower = members.withColumn("level", F.col("level") + 1).withColumn("j", F.lit(None).cast("int"))
    below = ways.select("key", (F.col("level") + 1).alias("level"), F.col("ways").alias("ways_below"))
    cols = ["key", "level", "rep", "root", "n", *SIGNATURE]
    inside = own.select(*cols, "i", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("j")).select(
        *cols, F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), F.lit(0).alias("kind")
    )
    upper = own.join(below, ["key", "level"]).select(
        *cols, "i", F.explode(F.sequence(F.lit(0), F.col("ways_below") - 1)).alias("j"), F.lit(1).alias("kind")
    )
    lower = (
        lower.join(below, ["key", "level"])
        .withColumn("j", F.pmod(F.xxhash64("rep"), F.col("ways_below")).cast("int"))
        .join(ways, ["key", "level"])
        .select(*cols, F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("i"), "j", F.lit(2).alias("kind"))
    )
    blocks = inside.unionByName(upper).unionByName(lower).join(marks, ["rep", "level"])
    group = ["key", "level", "i", "j", F.when(F.col("kind") == 0, 0).otherwise(1)]
    least = float(similarity) - MARGIN
    ratio = float(similarity)
    p, q = similarity.numerator, similarity.denominator

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        lower_side = rows["kind"].to_numpy() == 2
        left = rows[~lower_side]
        right = rows[lower_side] if lower_side.any() else left
        signs_r = right[SIGNATURE].to_numpy().view(np.uint64)
        n_r, root_r, rep_r = (right[c].to_numpy() for c in ("n", "root", "rep"))
        prints_r = np.frombuffer(b"".join(right["print"]), np.uint8).reshape(len(right), -1) if len(right) else None
        found = []
        for n, root, rep, mark, *sign in left[["n", "root", "rep", "print", *SIGNATURE]].itertuples(index=False, name=None):
            x = signs_r ^ np.array(sign, dtype=np.int64).view(np.uint64)
            for b in range(1, BITS):
                x = x | (x >> np.uint64(b))
            equal = 1.0 - np.bitwise_count(x & np.uint64(_LOWEST)).sum(axis=1) / PERMUTATIONS
            chance = 2.0**-BITS
            fits = ((equal - chance) / (1 - chance) >= least) & (root_r != root)
            fits &= np.minimum(n_r, n) >= ratio * np.maximum(n_r, n) - 1e-6
            at = np.flatnonzero(fits)
            if len(at):
                apart = np.count_nonzero(prints_r[at] != np.frombuffer(mark, np.uint8), axis=1)
                near = at[apart * (p + q) <= (n_r[at] + n) * (q - p)]
                found += [(min(rep, o), max(rep, o)) for o in rep_r[near].tolist()]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64").drop_duplicates()

    return blocks.groupBy(*group).applyInPandas(meet, "a bigint, b bigint").distinct()


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: Fraction = SIMILARITY) -> DataFrame:
    """``id``, ``th`` (:func:`nodes.text_hash`), ``n``, ``component`` and ``chosen`` for every row of ``docs``.

    ``chosen`` are the rows with the id and text that stand for their component: the smallest id's first text
    in it. Rows with a NULL id or an empty set are always chosen.
    """
    shared_dir(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    signed = staged(signatures(named), "signatures")
    known = signed.filter("id IS NOT NULL AND n > 0")
    nodes = Nodes.of(named, known)
    keys = nodes.sets.select("id", "th", F.col("node").alias("rep"))
    signs = known.drop("class").join(keys, ["id", "th"]).select("rep", "n", *SIGNATURE, "bands").dropDuplicates(["rep"])
    signs = staged(signs, "representatives")

    def check(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().checkpoint()
        return confirmed(pairs, nodes.texts(wanted), WORDS, similarity)

    banded = signs.select("rep", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
    shared = shared.filter("leader < last").select("key", "leader")
    buckets = banded.join(shared, "key").checkpoint()
    first = buckets.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = check(promising(first, signs, similarity).checkpoint()).checkpoint()
    labels = components(links).checkpoint()
    more = _rest(buckets, labels, signs, nodes.texts, similarity).join(first, ["a", "b"], "left_anti").checkpoint()
    if not more.isEmpty():
        # The components found so far stand for their links.
        linked = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
        labels = components(linked.unionByName(check(more))).checkpoint()
    placed = nodes.components(labels).withColumnsRenamed({"id": "_id", "th": "_th"})
    # Of a component's sets, the one with its smallest id stands for it: its own root, or a further set of a smaller id.
    stands = placed.filter(F.col("_id") == F.col("component")).groupBy("root").agg(F.min("node").alias("stands"))
    placed = spread_join(placed, stands, ["root"]).select("class", "_id", "_th", "component", (F.col("node") == F.col("stands")).alias("first"))
    found = spread_join(signed.select("id", "th", "class", "n"), placed, ["class"])
    member = F.col("id").isNotNull() & (F.col("n") > 0)
    mine = F.col("first") & (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th"))
    return found.select(
        "id", "th", "n", F.when(member, F.col("component")).otherwise(F.col("id")).alias("component"),
        F.when(member, mine).otherwise(True).alias("chosen"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: Fraction = SIMILARITY
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``."""
    return judged(docs, id_col, text_col, similarity).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: Fraction = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stand for their component, each id and text once.

    Rows with a NULL id all stay. Of rows that repeat an id and a text the one stays whose other columns come first.
    """
    mark, place = unused(docs, "_text_hash"), unused(docs, "_place")
    chosen = judged(docs, id_col, text_col, similarity).filter("chosen AND id IS NOT NULL")
    chosen = chosen.select(F.col("id").alias(id_col), F.col("th").alias(mark)).distinct()
    marked = docs.filter(F.col(id_col).isNotNull()).withColumn(mark, text_hash(text_col))
    rest = [c for c, kind in docs.dtypes if c not in (id_col, text_col) and not kind.startswith("map")] or [id_col]
    first = Window.partitionBy(id_col, mark).orderBy(*rest)
    kept = marked.join(chosen, [id_col, mark], "left_semi").withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1)
    return kept.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
