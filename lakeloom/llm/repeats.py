"""Exact repeated passages, found in a suffix order that is built column by column.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier. Passages are
not compared all with all:

1. Every window of ``LENGTH`` bytes names the smallest hash among its short grams. Runs of windows
   that share that gram form a segment. Equal windows have equal grams, so only segments whose
   gram occurs twice in the corpus can hold a repeated window. This leaves few segments.
2. Segments with equal bytes collapse to the first one. All windows of the others are repeats.
3. The different segments of one gram may still share windows, which then have the gram at the same
   offset. So their windows are dealt into ``SLABS`` by this offset. All windows of a slab have
   their inner ``SHARED`` bytes in common, and only slabs that agree in these go on. Equal slabs
   collapse like equal segments.
4. What is left, different slabs that agree inside, is put into bins, and the suffixes of a bin are sorted by inserting one symbol of every segment per round, from the
   last to the first: the Burrows-Wheeler transform of the suffixes known so far gives the places of
   the new ones, and their common prefixes with both neighbours follow from prefixes already known.
   Suffixes in a row with a common prefix of ``LENGTH`` are equal windows; all but the earliest
   are repeats.

The sequential files of the column-wise construction are arrays of a bin here: bins have a bounded
size, so nothing is written to a machine's own disk. Inner bytes with more different slabs than
``HOT`` do not go into a bin: their windows are grouped by digest, one row each, which has no bound
to keep.

Cases: a NULL text is empty; texts below ``LENGTH`` bytes lose nothing. A NULL id counts as the
smallest. Rows that repeat an id and a text are one document and come back one by one, with equal
results; rows that share an id but not the text are ordered by a digest of the text. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_ones
from ..operators.ordering import dense_key
from ..session import shared_dir
from ..sources.writers import staged
from .shingles import _BYTE, _mixed, _power_tables

LENGTH = 100  # bytes of a repeat
GRAM = 24  # bytes of the grams that name a window
PIECE = 1 << 16  # windows of a long text that are looked at together
CHUNK = 1 << 17  # bytes of several texts looked at together; positions have this many values
SLABS = 4
WIDTH = (LENGTH - GRAM) // SLABS  # offsets in a slab; the last one has the offset LENGTH - GRAM too
SHARED = LENGTH - WIDTH  # bytes that the windows of a slab have in common, about
BIN_BYTES = 1 << 20  # slabs of a bin, on average
HOT = 5_000  # different slabs with the same inner bytes from which on windows are grouped by digest
LIST_BYTES = 48 << 20  # lists of positions up to this size are sent to every executor

_FIRST = -(1 << 63)  # stands for a NULL id
_POSITION_BITS = 17
_START = np.uint8(255)  # stands before the first symbol; no UTF-8 text has this byte


# --- 1: segments ----------------------------------------------------------------------------


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of at most ``CHUNK`` bytes, in which texts end at ``ends``.

    Gram hash, hash of the segment's bytes, first window, number of windows and place of the gram of each.
    """
    none, zero = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(data)
    if n < LENGTH:
        return none, none, zero, zero, zero
    up, down = _power_tables(CHUNK + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n + 1 - GRAM])
    low = np.uint64((1 << _POSITION_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # ties go to the left
    reach, width = LENGTH - GRAM + 1, 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if reach > width:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    place = (least & low).astype(np.int64)  # of each window, where its gram starts
    text = np.zeros(n, dtype=np.int32)
    text[ends[:-1]] = 1
    text = np.cumsum(text)
    inside = text[: n - LENGTH + 1] == text[LENGTH - 1 :]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    starts = np.flatnonzero(opens)
    if not len(starts):
        return none, none, zero, zero, zero
    counts = np.add.reduceat(inside.astype(np.int64), starts)
    stops = starts + counts + LENGTH - 1
    whole = _mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    return grams[place[starts]], whole, starts, counts, place[starts]


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int]], np.ndarray]]:
    """Texts joined to chunks; long ones in pieces that overlap by one window less a byte.

    The bytes, (text number, offset in it) of every piece, and where the pieces end.
    """
    parts, named, size = [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            piece = text[at : at + PIECE + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if size + len(piece) > CHUNK:
                yield np.frombuffer(b"".join(parts), np.uint8), named, np.cumsum([len(p) for p in parts])
                parts, named, size = [], [], 0
            parts.append(piece)
            named.append((number, at))
            size += len(piece)
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), named, np.cumsum([len(p) for p in parts])


def _of_texts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Gram, content hash, text number, start in the text, number of windows and gram's place of all segments."""
    for data, named, ends in _chunks(texts):
        gram, whole, starts, counts, places = segments(data, ends)
        piece = np.searchsorted(ends, starts, side="right")
        numbers = np.array([n for n, _ in named], dtype=np.int64)
        offsets = np.array([o for _, o in named], dtype=np.int64) - np.concatenate([[0], ends[:-1]])
        yield gram.view(np.int64), whole.view(np.int64), numbers[piece], starts + offsets[piece], counts, places + offsets[piece]


def _bytes(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts.to_pylist()]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for gram, *_ in _of_texts(_bytes(batch.column(1))):
            values, counts = np.unique(gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["gram", "n"])


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for gram, whole, number, start, count, _ in _of_texts(_bytes(batch.column(1))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(whole), pa.array(ids[number]), pa.array(start * 256 + count)],
                ["key", "content", "id", "place"],
            )


def _slab_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slabs of the listed segments: key of the inner bytes, content hash, id and place."""
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(), _bytes(batch.column(1))
        wanted = [set(map(int, x.split(","))) for x in batch.column(2).to_pylist()]
        keys, contents, owners, places = [], [], [], []
        for _, _, number, start, count, gram in _of_texts(texts):
            for n, first, windows, p in zip(number.tolist(), start.tolist(), count.tolist(), gram.tolist()):
                if first not in wanted[n]:
                    continue
                text = texts[n]
                for slab in range((p - first - windows + 1) // WIDTH, min(SLABS - 1, (p - first) // WIDTH) + 1):
                    # Windows whose gram is at the offsets lo to hi.
                    lo, hi = slab * WIDTH, slab * WIDTH + WIDTH - 1 if slab < SLABS - 1 else LENGTH - GRAM
                    a, z = max(first, p - hi), min(first + windows - 1, p - lo)
                    if a > z:
                        continue
                    keys.append(_signed(xxhash.xxh3_64_intdigest(text[p - lo : p - hi + LENGTH], seed=slab)))
                    contents.append(_signed(xxhash.xxh3_64_intdigest(text[a : z + LENGTH])))
                    owners.append(int(ids[n]))
                    places.append(a * 256 + z - a + 1)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, contents, owners, places)], ["key", "content", "id", "place"])


def _slab_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of listed slabs (key, place), cut from the texts."""
    for batch in batches:
        keys, owners, starts, parts = [], [], [], []
        for id_, text, listed in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), batch.column(2).to_pylist()):
            marks = list(map(int, listed.split(",")))
            for key, place in zip(marks[::2], marks[1::2]):
                a, n = place >> 8, place & 255
                keys.append(key)
                owners.append(id_)
                starts.append(a)
                parts.append(text[a : a + n + LENGTH - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(owners, pa.int64()), pa.array(starts, pa.int64()), pa.array(parts, pa.binary())],
            ["key", "id", "start", "bytes"],
        )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# --- 3: suffix order of a bin -----------------------------------------------------------------


def _least_between(prefixes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Minimum of ``prefixes[start:stop]`` for every pair; pairs from right to left are cheapest."""
    if not len(starts):
        return np.zeros(0, prefixes.dtype)
    order = np.argsort(-starts, kind="stable")
    # Pairs are looked at from right to left, so what lies between two of them is never read.
    bounds = np.empty(2 * len(starts), dtype=np.int64)
    bounds[::2], bounds[1::2] = starts[order], stops[order]
    found = np.empty(len(starts), prefixes.dtype)
    found[order] = np.minimum.reduceat(np.append(prefixes, 0).astype(prefixes.dtype), bounds)[::2]
    return found


def suffix_order(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of a collection of strings and the common prefix of each with the one before.

    One symbol of every string is inserted per round. ``bwt`` has the symbol before every suffix
    known so far. A new suffix is that symbol and a known suffix, so a stable sort of ``bwt`` has
    the new suffixes at their places. Its neighbours with the same first symbol continue with
    known suffixes, whose common prefixes are minima over ``prefix``.
    """
    n = len(starts)
    stops = starts + lengths
    known = stops.astype(np.int32)  # suffixes as offsets into data; first the empty ones
    prefix = np.zeros(n, np.uint8)
    bwt = data[stops - 1].copy()
    latest = np.arange(n)  # where the last suffix of every string is
    live = np.arange(n)
    for depth in range(1, int(lengths.max(initial=0)) + 1):
        live = live[lengths[live] >= depth]
        at = latest[live]
        order = np.argsort(bwt, kind="stable")  # positions by the symbol before them
        first = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=256))])
        symbol = bwt[at]
        by_place = np.lexsort((at, symbol))
        live, at, symbol = live[by_place], at[by_place], symbol[by_place]
        rank = np.empty(len(at), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(at)]])):
            block = order[first[symbol[lo]] : first[symbol[lo] + 1]]
            rank[lo:hi] = first[symbol[lo]] + np.searchsorted(block, at[lo:hi])
        has_left = rank > first[symbol]
        has_right = rank + 1 < first[symbol.astype(np.int64) + 1]
        left = np.zeros(len(at), np.uint8)
        right = np.zeros(len(at), np.uint8)
        left[has_left] = 1 + _least_between(prefix, order[rank[has_left] - 1] + 1, at[has_left] + 1)
        right[has_right] = 1 + _least_between(prefix, at[has_right] + 1, order[rank[has_right] + 1] + 1)
        place = n + rank  # behind the empty suffixes
        old = np.ones(len(bwt) + len(at), dtype=bool)
        old[place] = False
        follows = np.minimum(place + 1, len(old) - 1)
        begin = stops[live] - depth
        merged = []
        before = np.where(begin > starts[live], data[np.maximum(begin - 1, 0)], _START)
        for values, new in ((bwt, before), (prefix, left), (known, begin)):
            whole = np.empty(len(old), values.dtype)
            whole[old] = values
            whole[place] = new
            merged.append(whole)
        bwt, prefix, known = merged
        inner = (place + 1 < len(old)) & old[follows]
        prefix[follows[inner]] = right[inner]
        moved = np.flatnonzero(~old)
        latest[live] = moved  # place ascends with (symbol, at), as live now does
    return known, prefix


def repeated_windows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Offsets of windows that an earlier offset holds too, ascending. Strings come in reading order."""
    known, prefix = suffix_order(data, starts, lengths)
    opens = np.flatnonzero(prefix < LENGTH)
    earliest = np.minimum.reduceat(known, opens)
    sizes = np.diff(np.append(opens, len(known)))
    return np.sort(known[known != np.repeat(earliest, sizes)])


def _in_bin(rows: pa.Table) -> pa.Table:
    """Spans of repeated windows among the segments of a bin."""
    rows = rows.sort_by([("id", "ascending"), ("start", "ascending")])
    ids, begins = rows["id"].to_numpy(), rows["start"].to_numpy()
    parts = rows["bytes"].to_pylist()
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    starts = np.cumsum(lengths) - lengths
    found = repeated_windows(data, starts, lengths)
    row = np.searchsorted(starts, found, side="right") - 1
    begin = begins[row] + found - starts[row]
    return _runs(ids[row], begin, np.ones(len(begin), dtype=np.int64))


def _runs(ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> pa.Table:
    """Spans ``(id, lo, hi)`` of neighbouring windows, joined where they touch."""
    opens = np.ones(len(begin), dtype=bool)
    opens[1:] = (ids[1:] != ids[:-1]) | (begin[1:] > begin[:-1] + count[:-1])
    firsts = np.flatnonzero(opens)
    lasts = np.append(firsts[1:], len(begin)) - 1
    if not len(firsts):
        lasts = firsts
    return pa.table({"id": ids[firsts], "lo": begin[firsts], "hi": begin[lasts] + count[lasts] + LENGTH - 1})


# --- the operator ------------------------------------------------------------------------------


def _listed(rows: DataFrame, value: Column) -> DataFrame:
    """Per id, its sorted values (arrays) as one text, so that the size is easy to measure."""
    values = F.flatten(F.sort_array(F.collect_list(value))).cast("array<string>")
    return rows.groupBy("id").agg(F.array_join(values, ",").alias("listed"))


def _with_list(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts next to their lists; the lists are broadcast where they are measured to be small."""
    (small,) = small_ones([lists], LIST_BYTES)
    return docs.join(F.broadcast(lists) if small else lists, "id", how)


def _by_digest(rows: DataFrame) -> DataFrame:
    """Spans of repeated windows by a digest per window, for grams with very many segments."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, start, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = len(data) - LENGTH + 1
                digests = [hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array([id_] * n, pa.int64()), pa.array(range(start, start + n), pa.int64())],
                    ["digest", "id", "lo"],
                )

    each = rows.select("id", "start", "bytes").mapInArrow(windows, "digest binary, id bigint, lo bigint")
    first = each.groupBy("digest").agg(F.min(F.struct("id", "lo")).alias("first"))
    return each.join(first, "digest").filter(F.struct("id", "lo") != F.col("first")).select("id", "lo", (F.col("lo") + LENGTH).alias("hi"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``id``, ``lo``, ``hi`` (end exclusive) of repeated bytes in ``docs (id, text)``; spans may overlap."""
    counts = docs.mapInArrow(_gram_counts, "key bigint, n bigint")
    twice = staged(counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"), "grams")
    rows = docs.mapInArrow(_segment_rows, _ROWS)
    copies, firsts = _collapsed(staged(rows.join(twice, "key", "left_semi"), "segments"))
    lists = _listed(firsts.select("id", "place").distinct(), F.array(F.shiftright("place", 8))).checkpoint()
    slabs = _with_list(docs, lists, "inner").select("id", "text", "listed").mapInArrow(_slab_rows, _ROWS)
    more, firsts = _collapsed(staged(slabs, "slabs"))
    lists = _listed(firsts, F.array("key", "place")).checkpoint()
    cut = _with_list(docs, lists, "inner").select("id", "text", "listed")
    cut = cut.mapInArrow(_slab_bytes, "key bigint, id bigint, start bigint, bytes binary")
    # Rows that repeat a document list its slabs again, which must not count as repeats of themselves.
    cut = staged(cut.dropDuplicates(["key", "id", "start"]), "contested")
    hot = cut.groupBy("key").count().filter(F.col("count") > HOT).select("key").checkpoint()
    size = cut.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0)).cast("bigint")).first()[0]
    spans, binned = copies.unionByName(more), cut
    if not hot.isEmpty():
        binned = cut.join(hot, "key", "left_anti")
        spans = spans.unionByName(_by_digest(cut.join(hot, "key", "left_semi")))
    bins = binned.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(max(1, -(-size // BIN_BYTES)))))
    return spans.unionByName(bins.groupBy("bin").applyInArrow(_in_bin, "id bigint, lo bigint, hi bigint"))


_ROWS = "key bigint, content bigint, id bigint, place bigint"


def _collapsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with equal key and content collapse to the first.

    The spans of all others, which are repeats as a whole, and those firsts (key, id, place)
    whose key has several contents.
    """
    firsts = rows.groupBy("key", "content").agg(F.min(F.struct("id", "place")).alias("first")).checkpoint()
    lo, n = F.shiftright("place", 8), F.col("place").bitwiseAND(F.lit(255).cast("bigint"))
    copies = rows.join(firsts, ["key", "content"]).filter(F.struct("id", "place") != F.col("first"))
    copies = copies.select("id", lo.alias("lo"), (lo + n + LENGTH - 1).alias("hi"))
    several = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return copies, firsts.join(several, "key").select("key", "first.id", "first.place")


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted, overlapping spans of an id joined."""
    for batch in batches:
        short = []
        for listed in batch.column(1).to_pylist():
            marks = np.fromstring(listed, dtype=np.int64, sep=",")
            lo, hi = marks[::2], np.maximum.accumulate(marks[1::2])
            opens = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
            lasts = np.append(opens[1:], len(lo)) - 1
            short.append(",".join(map(str, np.stack([lo[opens], hi[lasts]], axis=1).ravel().tolist())))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.string())], ["id", "listed"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary) for every row of ``docs``."""
    shared_dir(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("bigint").alias("own"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plain = plain.withColumn("id", F.coalesce("own", F.lit(_FIRST).cast("bigint")))
    told = plain.select("id", F.xxhash64("text").alias("hash")).distinct()
    if not told.groupBy("id").count().filter("count > 1").isEmpty():
        # Ids that stand for several texts: number the documents instead.
        numbers = dense_key(told, ["id", "hash"], "number")
        plain = plain.withColumn("hash", F.xxhash64("text")).join(numbers, ["id", "hash"])
        plain = plain.select("own", "text", F.col("number").alias("id"))
    spans = repeated_spans(plain.select("id", "text"))
    lists = _listed(spans, F.array("lo", "hi")).mapInArrow(_joined_spans, "id bigint, listed string").checkpoint()
    joined = _with_list(plain, lists, "left").select("own", "text", "listed")

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            for data, listed in zip(_bytes(batch.column(1)), batch.column(2).to_pylist()):
                parts, at, gone, count = [], 0, 0, 0
                marks = list(map(int, listed.split(","))) if listed else []
                reach = -1
                for lo, hi in zip(marks[::2], marks[1::2]):
                    if lo > reach:
                        parts.append(data[at:lo])
                        count += 1
                        gone += hi - lo
                    else:
                        gone += max(0, hi - reach)
                    reach = max(reach, hi)
                    at = reach
                parts.append(data[at:])
                sizes.append(len(data))
                removed.append(gone)
                runs.append(count)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(x, pa.int64()) for x in (sizes, removed, runs)] + [pa.array(kept, pa.binary())],
                ["own", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    result = joined.mapInArrow(applied, "own bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return result.withColumnRenamed("own", id_col)
