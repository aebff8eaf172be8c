"""Byte-level BPE encoding and decoding, split at forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be merged, so
the text may be cut there: the fragments are encoded on their own and their ids concatenated.
Of these pairs the ones are used where the pre-tokenizer always ends a piece too, so that a fragment
gives the same pieces as the whole text: a visible character and a space or line feed after it, and
a letter and a punctuation mark. Fragments are mostly words and repeat, so their ids are remembered.
Cuts at the remaining pairs, inside pieces, would be certain as well but cost more than they save.

Cases: a NULL text counts as empty; an empty text gives no ids and decodes to the empty text.
Special tokens written in a text get their own id, as the tokenizer itself does. Rows, repeated
rows and other columns stay as they are; a column named like an output is replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unused

VOCABULARY_LIMIT = 64 << 20  # bytes of vocabulary that go along with each task
REMEMBERED = 150_000  # fragments whose ids a worker keeps
PORTION = 500_000  # bytes or ids that are looked at a time
LONGEST = 64  # characters of a fragment that is remembered


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary of a byte-level tokenizer."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return table | {chr(0x100 + i): b for i, b in enumerate(rest)}


_ALPHABET = byte_alphabet()


class Codec:
    """One vocabulary file (JSON of the ``tokenizers`` library), ready to encode."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("a prefix space or a normalizer is not handled")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = _token_bytes(spec)
        self.inside = np.zeros((256, 256), dtype=bool)  # pairs that some token holds
        for i in spec["model"]["vocab"].values():
            for a, b in zip(tokens[i], tokens[i][1:]):
                self.inside[a, b] = True
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = True  # they are found before the fragments are made
        self.ints = list(range(len(tokens)))  # one object for each id
        self.words: dict[str, tuple[int, ...]] = {}  # ids of fragments between spaces
        self.parts: dict[str, tuple[int, ...]] = {}  # ids of their parts between letters and marks
        self._make_cuts()
        names = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def _make_cuts(self) -> None:
        """Patterns for the cuts, of those pairs only that no token holds."""
        visible = [a for a in range(0x21, 0x7F) if not self.inside[a, [0x20, 0x0A]].any()]
        self.everywhere = len(visible) == 0x7F - 0x21
        # Beyond ASCII the last byte of a letter may also end a no-break space, whose runs are tokens;
        # there the end of the piece alone makes the cut certain.
        self.cut = re.compile(f"(?:(?<={_one_of(visible)})|(?<=[^\\s\\x00-\\x7f]))(?=[ \n])")
        letters = [*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]
        marks = _one_of(b for b in b"!\"#$%&()*+,-./:;<=>?@[]^_{|}~" if not self.inside[letters, b].any())
        self.inner = re.compile(f"(?<=[A-Za-z])(?={marks})")

    def fragments(self, text: str) -> list[str]:
        """A text cut before spaces and around line feeds; specials stay whole."""
        if self.marks is not None and any(s in text for s in self.special):
            return [f for p in self.marks.split(text) for f in ((p,) if p in self.special else self._cut(p))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        if not self.everywhere or "\0" in text or _RUN.search(text):
            return self.cut.split(text)
        # No two white spaces together: every space starts a fragment, every line feed is one.
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def learn(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of fragments that are not remembered."""
        cut = {w: self.inner.split(w) for w in words if w not in self.special}
        parts = self.parts
        new = list({p for ps in cut.values() for p in ps if p not in parts})
        coded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        one = self.ints.__getitem__
        fresh = {p: tuple(map(one, e.ids)) for p, e in zip(new, coded)}
        known = lambda p: fresh[p] if p in fresh else parts[p]
        found = {w: known(ps[0]) if len(ps) == 1 else tuple(chain.from_iterable(map(known, ps))) for w, ps in cut.items()}
        self.parts = _joined(parts, fresh)
        return found | {w: (i,) for w, i in self.special.items() if w in words}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of some texts."""
        rows = [self.fragments(t) for t in texts]
        known = self.words
        new = self.learn({f for row in rows for f in row if f not in known})
        found = [[known[f] if f in known else new[f] for f in row] for row in rows]
        self.words = _joined(known, new)
        return [np.fromiter(chain.from_iterable(row), dtype=np.int32) for row in found]


class Decoder:
    """The bytes of every id of one vocabulary file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.table = pa.array(_token_bytes(spec), pa.large_binary())

    def decode(self, ids: pa.Array) -> list[str]:
        """Texts of a list array of ids; bytes that are no UTF-8 become U+FFFD."""
        ids = ids.cast(pa.list_(pa.int32()))
        flat = self.table.take(ids.flatten())
        ends = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1]
        data = memoryview(flat.buffers()[2] or b"")
        at = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        return [str(data[ends[a] : ends[b]], "utf-8", "replace") for a, b in zip(at[:-1], at[1:])]


def _token_bytes(spec: dict) -> list[bytes]:
    """Bytes of every token, by id."""
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocabulary = spec["model"]["vocab"]
    found = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
    for token, i in vocabulary.items():
        found[i] = bytes(_ALPHABET[c] for c in token)
    for token, i in special.items():
        found[i] = token.encode()
    return found


def _joined(known: dict, new: dict) -> dict:
    """``known`` with the short keys of ``new``, started anew when it is full."""
    known = {} if len(known) + len(new) > REMEMBERED else known
    known.update((k, v) for k, v in new.items() if len(k) <= LONGEST)
    return known


_RUN = re.compile(r"\s\s")


def _one_of(codes) -> str:
    """A pattern for one of these ASCII characters; for none, one that never fits."""
    return "[" + "".join(re.escape(chr(c)) for c in codes) + "]" if (codes := list(codes)) else "(?!)"


@lru_cache(maxsize=1)
def codec(text: str) -> Codec:
    return Codec(text)


@lru_cache(maxsize=1)
def decoder(text: str) -> Decoder:
    return Decoder(text)


def _vocabulary(spark, path: str):
    """The vocabulary file as a broadcast, after a check of its size."""
    with open(path, encoding="utf-8") as file:
        text = file.read(VOCABULARY_LIMIT + 1)
    if len(text) > VOCABULARY_LIMIT:
        raise ValueError(f"{path} has more than {VOCABULARY_LIMIT} characters")
    return spark.sparkContext.broadcast(text)


def encode(df: DataFrame, text_col: str, vocabulary: str, out: str = "ids") -> DataFrame:
    """Add ``out``, the token ids (array of int) of each text. ``vocabulary`` is a local file of the driver."""
    shared = _vocabulary(df.sparkSession, vocabulary)

    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = codec(shared.value)
        for texts in batches:
            for some in _portions(texts):
                yield _lists(tool.encode(some.to_pylist()))

    udf = F.arrow_udf(ids_of, "array<int>")
    return df.withColumn(out, udf(F.coalesce(F.col(text_col), F.lit(""))))


def round_trip(df: DataFrame, text_col: str, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``ids``, the token ids of each text, and ``decoded``, the text of these ids.

    Both in one pass, so the ids do not travel to another worker and back to be decoded.
    """
    shared = _vocabulary(df.sparkSession, vocabulary)
    both = unused(df, "_coded")

    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        to_ids, to_text = codec(shared.value), decoder(shared.value)
        for texts in batches:
            for some in _portions(texts):
                lists = _lists(to_ids.encode(some.to_pylist()))
                yield pa.StructArray.from_arrays([lists, pa.array(to_text.decode(lists), pa.string())], ["ids", "decoded"])

    udf = F.arrow_udf(coded, "struct<ids:array<int>,decoded:string>")
    found = df.withColumn(both, udf(F.coalesce(F.col(text_col), F.lit(""))))
    kept = [F.col(c) for c in df.columns if c not in (ids, decoded)]
    return found.select(*kept, F.col(f"{both}.ids").alias(ids), F.col(f"{both}.decoded").alias(decoded))


def _portions(values: pa.Array) -> Iterator[pa.Array]:
    """Slices with about ``PORTION`` characters or ids each, so that little is held at a time."""
    sizes = pc.binary_length(values) if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else values.value_lengths()
    before = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False)) // PORTION
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(values)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield values.slice(lo, hi - lo)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32, copy=False)))


def decode(df: DataFrame, ids_col: str, vocabulary: str, out: str = "decoded") -> DataFrame:
    """Add ``out``, the text of each list of ids. NULL gives the empty text."""
    shared = _vocabulary(df.sparkSession, vocabulary)

    def texts_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = decoder(shared.value)
        for ids in batches:
            for some in _portions(ids):
                yield pa.array(tool.decode(some), pa.string())

    udf = F.arrow_udf(texts_of, "string")
    return df.withColumn(out, udf(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))
