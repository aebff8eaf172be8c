"""How the terms of each source differ from the other sources of its language, and from the language.

1. Terms are runs of ASCII letters and of all characters beyond ASCII, with only A-Z in lower case. A
   portion of texts becomes one byte array, in which every term is a start and a length. Terms are
   counted in buckets by length: up to 8 bytes are packed into one 64-bit word, up to 16 into two,
   and a radix sort over 16-bit digits brings equal words together; longer terms are sorted as bytes,
   one bucket for each length. Runs of equal (group, term) give the occurrences, changes of the
   document within a run give the documents.
2. Counts are added up per (language, source, term), combined before the shuffle, and a language keeps
   the terms in at least ``MIN_DOCS`` of its documents.
3. With ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` two groups differ in a term by
   ``floor((p - q)^2 / (p + q))``. Pairs of sources are summed over all kept terms by partial sums per
   batch of terms, blocks of sources side by side; the result has one row for every pair anyway.
   Terms of one source against its language are ranked after each task has left its best ones only.

All arithmetic is in whole numbers: sums and quotients of a count are exact up to
``COUNT_LIMIT`` occurrences of kept terms in a language, beyond which it is an error, not an overflow.

Cases: a NULL text, language or source reads as the empty string. A group without terms, or of a
language that keeps none, still has its ``pair`` rows. A text of any length is worked through in
pieces and counts as one document. Rows that repeat a document count again. An empty table gives no
rows. Only the three named columns are read, so further columns and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import shared_dir
from ..sources.writers import staged

MIN_DOCS = 10  # documents of a language that must hold a term
TOP_TERMS = 10  # ranks of terms in the result
UNIT = 10**9  # a share of 1
PORTION = 4 << 20  # bytes of text looked at together
BLOCK = 128  # sources side by side
CELLS = 1 << 20  # differences computed at a time
COUNT_LIMIT = 9 * 10**15  # so that a thousand times a count is a 64-bit number

#: Each byte of a term in lower case; 0 for the bytes between terms.
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], dtype=np.uint64)  # the first k bytes of a word


# --- 1: terms of a portion -----------------------------------------------------------------


def _radix_order(digits: list[np.ndarray]) -> np.ndarray:
    """Stable order by 16-bit digits, the least significant one first."""
    order = None
    for digit in digits:
        if digit.min() == digit.max():
            continue
        step = np.argsort(digit if order is None else digit[order], kind="stable")  # radix sort for 16 bits
        order = step if order is None else order[step]
    return np.arange(len(digits[0])) if order is None else order


def _digits(words: np.ndarray) -> list[np.ndarray]:
    return [(words >> np.uint64(s)).astype(np.uint16) for s in (0, 16, 32, 48)]


def _runs(different: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and number of documents of each run; ``different`` says where one begins."""
    starts = np.flatnonzero(different)
    other = different.copy()
    other[1:] |= docs[1:] != docs[:-1]
    counts = np.diff(np.append(starts, len(different)))
    return starts, counts, np.add.reduceat(other.astype(np.int64), starts)


def _text_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Slices of ``data`` as strings."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[at])).cast(pa.string())


def counted_terms(data: np.ndarray, doc_ends: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Group number, term, occurrences and documents, bucket by bucket.

    ``data`` holds the documents' bytes, each document closed by a 0 byte at ``doc_ends - 1``; ``groups`` has
    the group number of each document.
    """
    data = np.concatenate([[np.uint8(0)], _LETTER[data], np.zeros(16, np.uint8)])
    edges = np.flatnonzero(np.diff((data != 0).view(np.int8)))
    starts, lengths = edges[::2] + 1, edges[1::2] - edges[::2]
    docs = np.searchsorted(doc_ends, starts - 1, side="right")
    word_at = np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))

    def bucket(chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        s, n, d = starts[chosen], lengths[chosen], docs[chosen]
        return s, n, d, groups[d]

    def found(order, same, s, n, d, g):
        """``same``: whether a term in order equals the one before."""
        g, d = g[order], d[order]
        first = np.concatenate([[True], ~same | (g[1:] != g[:-1])])
        at, counts, held = _runs(first, d)
        mine = order[at]
        return g[at], _text_bytes(data, s[mine], n[mine]), counts, held

    for low, high in ((1, 8), (9, 16)):
        s, n, d, g = bucket((lengths >= low) & (lengths <= high))
        if not len(s):
            continue
        words = [word_at[s].astype(np.uint64) & _KEEP[np.minimum(n, 8)]]
        if high > 8:
            words.append(word_at[s + 8].astype(np.uint64) & _KEEP[n - 8])
        digits = [x for w in reversed(words) for x in _digits(w)] + [g.astype(np.uint16), (g >> 16).astype(np.uint16)]
        order = _radix_order(digits)
        same = np.ones(len(order) - 1, bool)
        for w in words:
            w = w[order]
            same &= w[1:] == w[:-1]
        yield found(order, same, s, n, d, g)
    for size in np.unique(lengths[lengths > 16]).tolist():
        s, n, d, g = bucket(lengths == size)
        terms = np.ndarray((len(data) - size + 1,), dtype=f"S{size}", buffer=data, strides=(1,))[s]
        order = np.argsort(terms, kind="stable")
        order = order[_radix_order([g[order].astype(np.uint16), (g[order] >> 16).astype(np.uint16)])]
        terms = terms[order]
        yield found(order, terms[1:] == terms[:-1], s, n, d, g)


def _pieces(text: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in pieces that end between two terms."""
    at = 0
    while at < len(text):
        stop = min(at + limit, len(text))
        while stop < len(text) and _LETTER[text[stop]]:
            ahead = np.flatnonzero(_LETTER[text[stop : stop + limit]] == 0)
            stop = stop + int(ahead[0]) if len(ahead) else min(stop + limit, len(text))
        yield text[at:stop]
        at = stop


def _portions(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive documents of at most ``limit`` bytes; a longer one alone."""
    lo, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def _closed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents side by side, a 0 byte behind each, and their ends."""
    zero = np.zeros(1, np.uint8)
    data = np.concatenate([x for t in texts for x in (t, zero)])
    return data, np.cumsum([len(t) + 1 for t in texts])


def _of_long(text: np.ndarray, limit: int) -> pa.Table:
    """Terms of one text, counted piece by piece; they are in one document."""
    total = None
    for piece in _pieces(text, limit):
        data, ends = _closed([piece])
        parts = [pa.table({"term": t, "n": c}) for _, t, c, _ in counted_terms(data, ends, np.zeros(1, np.int64))]
        for part in parts:
            both = part if total is None else pa.concat_tables([total, part])
            total = both.group_by("term").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["term", "n"])
    return total if total is not None else pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64())})


def _term_counter(limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "docs"]
        for batch in batches:
            texts = batch.column(2).cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for lo, hi in _portions(np.diff(offsets), limit):
                lang, source = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
                if hi == lo + 1 and offsets[hi] - offsets[lo] > limit:
                    found = _of_long(raw[offsets[lo] : offsets[hi]], limit).combine_chunks()
                    rows = len(found)
                    one = lambda a: pa.array([a[0].as_py()] * rows, pa.string())
                    for part in found.to_batches():
                        yield pa.RecordBatch.from_arrays([one(lang), one(source), part["term"], part["n"], pa.array(np.ones(rows, np.int64))], names)
                    continue
                data, ends = _closed([raw[offsets[i] : offsets[i + 1]] for i in range(lo, hi)])
                seen: dict[tuple[str, str], int] = {}
                groups = np.array([seen.setdefault(x, len(seen)) for x in zip(lang.to_pylist(), source.to_pylist())], dtype=np.int64)
                langs, sources = (pa.array([x[k] for x in seen], pa.string()) for k in (0, 1))
                for g, term, n, docs in counted_terms(data, ends, groups):
                    g = pa.array(g)
                    yield pa.RecordBatch.from_arrays([langs.take(g), sources.take(g), term, pa.array(n), pa.array(docs)], names)

    return count


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", portion: int = PORTION) -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``docs`` of all terms."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    parts = named.mapInArrow(_term_counter(portion), "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- 2: shares ------------------------------------------------------------------------------


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT (n + 2) / (total + 2 terms))``, in DECIMAL so that nothing overflows."""
    up = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", up, (total + 2 * terms).cast("decimal(20,0)")).cast("bigint") + 1


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """The same share in numpy: long division, three digits at a time."""
    below = totals + 2 * terms
    if below.size and int(below.max()) >= COUNT_LIMIT:
        raise OverflowError("too many occurrences in one language for exact 64-bit shares")
    whole, rest = np.divmod(counts + 2, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the terms of a batch for each ordered pair of sources of a language."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == number)
            part = batch.take(pa.array(rows))
            names = part.column(3)[0].as_py()
            totals = np.array(part.column(4)[0].as_py(), dtype=np.int64)
            terms = part.column(5)[0].as_py()
            place = {s: i for i, s in enumerate(names)}
            at = np.repeat(np.arange(len(rows)), part.column(1).value_lengths().to_numpy(zero_copy_only=False))
            who = np.array([place[s] for s in part.column(1).flatten().to_pylist()], dtype=np.int64)
            much = part.column(2).flatten().to_numpy(zero_copy_only=False)
            size = len(names)
            for i in range(0, size, BLOCK):
                for j in range(i, size, BLOCK):
                    cols = (slice(i, i + BLOCK), slice(j, j + BLOCK))
                    shape = [len(totals[c]) for c in cols]
                    sums = np.zeros(shape, np.int64)
                    step = max(1, CELLS // (shape[0] * shape[1]))
                    for lo in range(0, len(rows), step):
                        inside = (at >= lo) & (at < lo + step)
                        sides = []
                        for c in cols:
                            mine = inside & (who >= c.start) & (who < c.stop)
                            counts = np.zeros((min(step, len(rows) - lo), len(totals[c])), np.int64)
                            counts[at[mine] - lo, who[mine] - c.start] = much[mine]
                            sides.append(shares(counts, totals[c][None, :], terms))
                        p, q = sides[0][:, :, None], sides[1][:, None, :]
                        sums += ((p - q) * (p - q) // (p + q)).sum(axis=0)
                    a, b = np.meshgrid(np.arange(i, i + shape[0]), np.arange(j, j + shape[1]), indexing="ij")
                    a, b, v = a.ravel(), b.ravel(), sums.ravel()
                    if i == j:
                        keep = a != b
                        a, b, v = a[keep], b[keep], v[keep]
                    else:  # the difference is the same from both sides
                        a, b, v = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([v, v])
                    of = pa.array(names, pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(a), pa.string()), of.take(pa.array(a)), of.take(pa.array(b)), pa.array(v)],
                        ["lang", "source", "item", "value"],
                    )


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP_TERMS, portion: int = PORTION,
) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    shared_dir(docs.sparkSession)
    found = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    groups = docs.select(*found).distinct()
    # One row per kept term, with the sources that have it: at most all sources of the language.
    kept = (
        term_counts(docs, text_col, lang_col, source_col, portion)
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("held"))
        .filter(F.col("docs") >= min_docs)
    )
    kept = staged(kept.select("lang", "term", "n", "held"), "kept-terms")
    each = kept.select("lang", "term", F.col("n").alias("all"), F.inline("held"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per group and one per language: small next to the data, but measured before any broadcast.
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"), "lang_total")
    groups = groups.checkpoint()

    known = groups.filter("terms > 0")
    p = _share(F.col("n"), F.col("total"), F.col("terms"))
    q = _share(F.col("all"), F.col("lang_total"), F.col("terms"))
    terms = spread_join(each, known, ["lang", "source"], "inner").select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    terms = terms.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", _difference(F.col("p"), F.col("q")).alias("value"))

    rosters = known.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("r"), F.max("terms").alias("terms"))
    rosters = rosters.select("lang", F.col("r.source").alias("sources"), F.col("r.total").alias("totals"), "terms")
    rows = spread_join(kept.select("lang", F.col("held.source").alias("who"), F.col("held.n").alias("much")), rosters, ["lang"], "inner")
    sums = rows.select("lang", "who", "much", "sources", "totals", "terms").mapInArrow(_pair_sums, "lang string, source string, item string, value bigint")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.filter("terms = 0").select("lang", "source")
    others = bare.select("lang", F.col("source").alias("item"))
    nothing = bare.join(others, "lang").filter("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    pairs = pairs.unionByName(nothing).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", place).unionByName(terms.withColumn("rank", place).filter(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
