"""Personal data by candidates and boosted trees.

1. Base detectors find e-mail and IP addresses, card and phone numbers by format and check digit.
   Their spans always stay.
2. Generators with high recall propose further, overlapping spans: anything around an ``@``, dotted
   numbers, digit groups, long tokens.
3. Boosted trees score every candidate by its format and its context. A candidate is taken where
   the score reaches the threshold of its kind; it is dropped if it overlaps a base span or a
   better candidate.

The trees are fitted here. A hash of the whole text holds every third text out. Of the others, about
``SAMPLE`` different texts are drawn for every kind, half of them among those with a positive and half
among those with another candidate of the kind, so rare kinds are learned too. No labels of people are
needed: spans that pass a base detector, or tokens assigned to a name such as ``password``, are
positive. Each gives further examples in its own context: altered forms that are still personal
(a phone number without its country code, a token without the name before it) and broken ones
that are not (a wrong check digit, a number over 255, a missing domain). Thresholds are set on all
different held-out texts, by counts per step of the score: the lowest one from which on ``PRECISION`` of
the candidates are right. A kind that has none adds no spans; ``Model.silent`` and a warning name it.

Cases: a NULL or empty text has no spans. If the sample has no two kinds of labels (an empty or tiny table), there
is no model and only base spans are found. Rows, repeated rows and other columns stay as they are;
a column with the name of the result is replaced. Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import logging
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

KINDS = ("email", "ip", "card", "phone", "secret")
SAMPLE = 4000  # different texts of each kind whose candidates the trees are fitted on, about
STEPS = 10_000  # of the score, in which held-out candidates are counted
TREES, DEPTH = 20, 3
PRECISION = 0.98
LONG = (100, 300, 1600)  # lengths of further examples of tokens, so that long ones are not taken for odd
CONTEXT = 24  # characters looked at before a candidate
SPAN = "struct<kind:string,start:int,end:int,base:boolean>"

# --- base detectors -----------------------------------------------------------------------
# Fixed formats. A run of local characters is entered at its start only, so long runs take linear time.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE = re.compile(_EMAIL)
_EMAIL_NEXT = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        # Right behind a match a new one may start inside the same run; elsewhere only at its start.
        found = (at and _EMAIL_HERE.match(text, at)) or _EMAIL_NEXT.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base detectors, kind by kind."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m.group().split("."))):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37 and 14 <= len(d := _only_digits(m.group())) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_only_digits(m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return found


#: How an address separates its two parts; fixed forms.
AT = ("@", " at ", "(at)", "[at]")

# --- candidates and features ----------------------------------------------------------------
# No upper bounds on names, domains and tokens: a run is entered at its start only, so long ones take linear time.
_GENERATORS = (
    ("email", re.compile(r"(?<![^\s<>\"'(,;])[^\s<>\"'(),;@]+(?:@| at |\(at\)|\[at\])[^\s<>\"'(),;@]{2,}+")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3}(?![0-9.]*[0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){8,14}(?![0-9A-Za-z])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+")),
)
# Words that announce personal data.
_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "debit", "account", "iban"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "whatsapp"),
    "secret": ("token", "key", "secret", "passw", "pwd", "auth", "bearer"),
}
_ASSIGNED = re.compile(r"(?:token|key|secret|passw\w*|pwd|auth\w*)[\w -]{0,12}[=:]\s*[\"']?\Z", re.I)
FEATURES = 24


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping spans that may be personal. A generator is left out only where the text lacks what it must find."""
    digit, at = bool(_DIGIT.search(text)), any(sign in text for sign in AT)
    return [
        (kind, *m.span()) for kind, pattern in _GENERATORS if (at if kind == "email" else digit) for m in pattern.finditer(text)
    ]


def features(kind: str, span: str, before: str, after: str) -> list[float]:
    """Format of the span and what stands around it."""
    digits = _only_digits(span)
    letters = sum(c.isalpha() for c in span)
    # What means nothing for a kind is constant for it, so that no tree splits on noise.
    numeric = kind in ("ip", "card", "phone")
    groups = re.split(r"[^0-9]+", span.strip("+()- .")) if numeric else ["0"]
    left = before.lower()
    numbers = [int(g) for g in groups if 0 < len(g) <= 9] if kind == "ip" else []
    return [
        float(KINDS.index(kind)),
        float(len(span)),
        float(len(digits) if numeric else 0),
        float(letters if numeric else 0),
        len(digits) / len(span) if numeric else 0.0,
        len(set(span)) / len(span),
        float(len(set(span))),
        float(len(groups)),
        float(max(map(len, groups))),
        float(min(map(len, groups))),
        float(max(numbers, default=0)),
        float(kind == "card" and luhn(digits)),
        float(span.startswith("+")),
        float("(" in span),
        float(span.count(".")),
        float(span.count("-") + span.count(" ")),
        float("@" in span),
        float("." in span.rpartition("@")[2]),
        float(sum(c.isupper() for c in span)),
        float(any(w in left for w in _WORDS[kind])),
        float(bool(re.search(r"[=:]\s*[\"']?\Z", before))),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(all(c in "0123456789abcdefABCDEF" for c in span)),
    ]


def _variants(kind: str, span: str, before: str) -> list[tuple[str, str, bool]]:
    """Further examples from a positive one: span, text before it and whether it is still personal."""
    turned = "".join(str((int(c) + 1) % 10) if c in "0123456789" and i == len(span) - 1 else c for i, c in enumerate(span))
    if kind == "email":
        local, _, domain = span.partition("@")
        return [(f"{local} at {domain}", before, True), (f"{local}@{domain.replace('.', '')}", before, False)]
    if kind == "ip":
        head, _, last = span.rpartition(".")
        return [(f"{head}.{int(last.lstrip('0') or 0) + 256}", before, False), (head, before, False)]
    if kind == "card":
        return [(turned, before, False)]
    if kind == "phone":
        short = re.sub(r"^\+[0-9]{1,3}[\x20.-]?(?=[(0-9])", "", span)
        return [(short, before, len(_only_digits(short)) >= 9), (span[: len(span) // 2], before, False)]
    bare = re.sub(r"\S+\s*[=:]\s*[\"']?\Z", "", before)
    drawn = [hashlib.shake_128(f"{k}{span}".encode()) for k in range(4)]
    other = [d.hexdigest((len(span) + 1) // 2)[: len(span)] for d in drawn]  # tokens of the same make
    longer = [n for n in LONG if n > len(span)]
    signs = sorted(set(span))
    other += ["".join(signs[b % len(signs)] for b in hashlib.shake_128(f"{n}{span}".encode()).digest(n)) for n in longer]
    broken = [(span[0] * n, before, False) for n in (len(span), *longer)]
    return [(span, bare, True), *((t, before, True) for t in other), *broken]


def _window(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - CONTEXT) : start], text[end : end + 2]


def labelled(text: str) -> list[tuple[str, int, int, bool]]:
    """Candidates of a text and whether they are positive, without parts of other base spans."""
    base = set(base_spans(text))
    # In order of their starts, the two furthest ends so far: a candidate lies in a span, or in two, if these reach its end.
    around = sorted((s, e) for k, s, e in base if k != "card")
    starts, furthest, second = [s for s, _ in around], [-1], [-1]
    for _, e in around:
        furthest.append(max(furthest[-1], e))
        second.append(max(second[-1], min(furthest[-2], e)))
    found = []
    for kind, start, end in candidates(text):
        mine = (kind, start, end) in base
        good = mine or kind == "secret" and bool(_ASSIGNED.search(text[max(0, start - CONTEXT) : start]))
        # A part of another base span is neither a good nor a bad example.
        before = bisect_right(starts, start)
        if (second if mine and kind != "card" else furthest)[before] < end:
            found.append((kind, start, end, good))
    return found


class _Taken:
    """Disjoint intervals, to be asked whether another one meets them."""

    def __init__(self, spans: list[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start

    def add(self, start: int, end: int) -> None:
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def examples(text: str) -> list[tuple[str, list[float], float]]:
    """Kind, features and label of the candidates of a text, with their variants."""
    found = []
    for kind, start, end, good in labelled(text):
        span, (before, after) = text[start:end], _window(text, start, end)
        found.append((kind, features(kind, span, before, after), float(good)))
        if good:
            found += [(kind, features(kind, s, b, after), float(p)) for s, b, p in _variants(kind, span, before) if s]
    return found


# --- the model ------------------------------------------------------------------------------


@dataclass
class Model:
    """Boosted trees as flat arrays, and a threshold per kind."""

    weights: list[float]
    trees: list[list[tuple]]  # of each node: (feature, threshold, left, right) or (None, value)
    thresholds: dict[str, float]

    @property
    def silent(self) -> tuple[str, ...]:
        """Kinds without a threshold: only their base spans are found."""
        return tuple(k for k in KINDS if k not in self.thresholds)

    def score(self, x: list[float]) -> float:
        total = 0.0
        for weight, nodes in zip(self.weights, self.trees):
            node = nodes[0]
            while node[0] is not None:
                node = nodes[node[2] if x[node[0]] <= node[1] else node[3]]
            total += weight * node[1]
        return 1.0 / (1.0 + float(np.exp(-2.0 * total)))

    def spans(self, text: str) -> list[tuple[str, int, int, bool]]:
        """All spans of a text, by start, then in the order of ``KINDS``."""
        base = base_spans(text)
        chosen = [(k, s, e, True) for k, s, e in base]
        covered, scored = _Taken([(s, e) for _, s, e in base]), []
        for kind, start, end in candidates(text) if self.trees else ():
            if kind in self.thresholds and not covered.meets(start, end):
                value = self.score(features(kind, text[start:end], *_window(text, start, end)))
                if int(value * STEPS) >= round(self.thresholds[kind] * STEPS):
                    scored.append((-value, start, -end, kind))
        taken = _Taken()
        for _, start, end, kind in sorted(scored):
            if not taken.meets(start, -end):
                taken.add(start, -end)
                chosen.append((kind, start, -end, False))
        return sorted(chosen, key=lambda c: (c[1], KINDS.index(c[0]), c[2]))


def _flat(node) -> list[tuple]:
    """A fitted tree as a list of nodes, children after their parent."""
    if node.numDescendants() == 0:
        return [(None, node.prediction())]
    left, right = _flat(node.leftChild()), _flat(node.rightChild())
    moved = lambda nodes, by: [n if n[0] is None else (n[0], n[1], n[2] + by, n[3] + by) for n in nodes]
    split = node.split()
    return [(split.featureIndex(), split.threshold(), 1, 1 + len(left)), *moved(left, 1), *moved(right, 1 + len(left))]


def _place(hash_: int) -> float:
    """Where a text lies between 0 and 1 by its hash, apart from the remainder that holds it out."""
    return (hash_ >> 16 & 0xFFFFFFFF) / (1 << 32)


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees from a bounded sample of ``docs``, thresholds from all of its held-out texts."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    shared_dir(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9]|" + "|".join(map(re.escape, AT)))).select("text", F.xxhash64("text").alias("hash"))
    held_out = F.pmod("hash", F.lit(3)) == 0

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, g, h) for t, h in zip(*(c.to_pylist() for c in batch.columns)) for k, g in {(k, g) for k, _, _, g in labelled(t)}]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["kind", "good", "hash"])

    # Different texts of each group, so that copies do not fill the sample.
    counts = texts.filter(~held_out).mapInArrow(groups, "kind string, good boolean, hash bigint").groupBy("kind", "good")
    shares = {(r.kind, r.good): SAMPLE / 2 / r.n for r in counts.agg(F.approx_count_distinct("hash").alias("n")).collect()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, hash_ in zip(*(c.to_pylist() for c in batch.columns)):
                place = _place(hash_)
                if place < most and any(place < shares.get((k, g), 1.0) for k, _, _, g in labelled(text)):
                    _, values, labels = zip(*examples(text))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([hash_] * len(labels), pa.int64()),
                            pa.array(range(len(labels)), pa.int32()),
                            pa.array(values, pa.list_(pa.float64())),
                            pa.array(labels, pa.float64()),
                        ],
                        ["hash", "nth", "values", "label"],
                    )

    most = max(shares.values(), default=0.0)
    drawn = texts.filter(~held_out).mapInArrow(rows, "hash bigint, nth int, values array<double>, label double")
    fitted = drawn.dropDuplicates(["hash", "nth"]).checkpoint()
    if fitted.agg(F.count_distinct("label")).first()[0] < 2:
        return Model([], [], {})
    grower = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=11, cacheNodeIds=False
    )
    # The sample is bounded; in one order, however the documents are partitioned, the trees are the same.
    ordered = fitted.repartition(1).sortWithinPartitions("hash", "nth")
    model = grower.fit(ordered.select(array_to_vector("values").alias("vector"), "label"))
    result = Model(
        [float(w) for w in model.treeWeights], [_flat(t._call_java("rootNode")) for t in model.trees], {}
    )
    result.thresholds = _thresholds(_scored(texts.filter(held_out), result))
    if result.silent:
        logging.getLogger(__name__).warning("no threshold, only base spans: %s", ", ".join(result.silent))
    return result


def _scored(texts: DataFrame, model: Model) -> pd.DataFrame:
    """``kind``, ``step`` of the score, ``n`` candidates and how many of them are ``right``, over different texts."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, hash_ in zip(*(c.to_pylist() for c in batch.columns)):
                count = Counter((kind, int(shared.value.score(values) * STEPS), label) for kind, values, label in examples(text))
                rows += [(hash_, *key, n) for key, n in count.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["hash", "kind", "step", "label", "n"])

    counts = texts.mapInArrow(steps, "hash bigint, kind string, step bigint, label double, n bigint").dropDuplicates(["hash", "kind", "step", "label"])
    # At most STEPS rows of a kind.
    return counts.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right")).toPandas()


def _thresholds(counts: pd.DataFrame) -> dict[str, float]:
    """Per kind, the lowest step of the held-out scores from which on ``PRECISION`` of the candidates are right."""
    found = {}
    for kind, rows in counts.groupby("kind"):
        rows = rows.sort_values("step", ascending=False)
        right = rows["right"].cumsum() / rows["n"].cumsum()
        good = rows["step"][(right >= PRECISION) & (2 * rows["step"] >= STEPS)]
        if len(good):
            found[str(kind)] = int(good.min()) / STEPS
    return found


def find(df: DataFrame, model: Model, text_col: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: the spans of every text as an array of structs (kind, start, end, base)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def spans_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        for texts in batches:
            found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in shared.value.spans(t)] for t in texts.to_pylist()]
            yield pa.array(found, pa.list_(kind))

    udf = F.arrow_udf(spans_of, f"array<{SPAN}>")
    return df.withColumn(out, udf(F.coalesce(F.col(text_col), F.lit(""))))


def _without(text: str, spans: list[tuple]) -> str:
    parts, at = [], 0
    for kind, start, end, *_ in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with every span of its texts replaced by its kind, found and replaced in one pass. NULL stays NULL."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_without(t, shared.value.spans(t)) if t else t for t in texts.to_pylist()], pa.string())

    return df.withColumn(text_col, F.arrow_udf(clean, "string")(F.col(text_col)))


def redacted(text: str | Column, spans: str | Column) -> Column:
    """The text with every span replaced by its kind in brackets, overlapping spans together by the first."""

    def replaced(texts: pa.Array, lists: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), lists.to_pylist())
        return pa.array([_without(t, [(s["kind"], s["start"], s["end"]) for s in found or ()]) if t else t for t, found in rows], pa.string())

    replaced.__annotations__ = {"texts": pa.Array, "lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(replaced, "string")(text, spans)


def listed(spans: str | Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ","
    )
