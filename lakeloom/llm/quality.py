"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule. A policy is a named version with the mask of the rules it enforces, so a new policy
or the effect of leaving a rule out (ablation) needs the ledger only, never the texts.

Cases: a NULL text has no words and so fails ``few_words``; the other rules compare with
``n_words = 0`` or no lines and pass. Repeated rows are judged alike. All input columns stay; a
column with the name of the ledger is replaced. An empty table gives an empty ledger, and the
ablation then has zeros. Native expressions only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_UPPER, bound, words_of

WINDOW = 8  # words in a window that may not come twice
SYMBOLS = "#*$%&|<>"

#: name -> failure, over the measurements ``m``; the order gives the bits.
RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "few_words": lambda m: m("n_words") < 20,
    "repeated_words": lambda m: 100 * m("n_repeat_words") > 30 * m("n_words"),
    "symbols": lambda m: 10 * m("n_symbols") > m("n_words"),
    "word_length": lambda m: (m("word_chars") < 3 * m("n_words")) | (m("word_chars") > 12 * m("n_words")),
    "repeated_lines": lambda m: 2 * m("n_dup_lines") > m("n_lines"),
    "shouting": lambda m: 2 * m("n_upper") > m("word_chars"),
}


@dataclass(frozen=True)
class Policy:
    """A version of the rules in force."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = list(RULES)
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
CURRENT = Policy("2", tuple(RULES))
POLICIES: Mapping[str, Policy] = {p.version: p for p in (BASE, CURRENT)}


def _repeated(words: Column) -> Column:
    """Words covered by windows that the text holds twice or more.

    Windows are compared by 64-bit hashes, built by doubling: one hash per word, per 2, 4 and 8
    words. A text without a repeated window, the usual case, is settled by a distinct count; only
    the others are sorted.
    """
    n = F.size(words)

    def doubled(h: Column, reach: int) -> Column:
        length = F.size(h) - reach
        return F.zip_with(F.slice(h, 1, length), F.slice(h, reach + 1, length), lambda a, b: F.xxhash64(a, b))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = bound(
            placed,
            lambda a: F.filter(
                a,
                lambda e, i: F.coalesce(F.get(a, i - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get(a, i + 1)["h"] == e["h"], F.lit(False)),
            ),
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda e: e["i"])),
            start,
            lambda acc, i: F.struct(
                (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end")
            ),
            lambda acc: acc["n"],
        )

    def settled(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))

    hashes = bound(F.transform(words, lambda w: F.xxhash64(w)), lambda h: bound(doubled(h, 1), lambda p: bound(doubled(p, 2), lambda q: doubled(q, 4))))
    return F.when(n <= WINDOW, 0).otherwise(bound(hashes, settled)).cast("bigint")


def measurements(text: Column) -> Column:
    """All measurements of a text as a struct of BIGINT."""
    text = F.coalesce(text, F.lit(""))

    def lines_of(t: Column) -> Column:
        return F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def all_of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            (F.length(text) - F.length(F.translate(text, ASCII_UPPER, ""))).cast("bigint").alias("n_upper"),
            bound(lines_of(text), lambda x: F.struct(F.size(x).cast("bigint").alias("n"), F.size(F.array_distinct(x)).cast("bigint").alias("d"))).alias("lines"),
            _repeated(words).alias("n_repeat_words"),
        )

    def flat(m: Column) -> Column:
        named = [m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_upper", "n_repeat_words")]
        lines = m["lines"]
        return F.struct(*named, lines["n"].alias("n_lines"), (lines["n"] - lines["d"]).alias("n_dup_lines"))

    return bound(bound(words_of(text), all_of), flat)


def ledger(df: DataFrame, text_col: str = "text", out: str = "ledger") -> DataFrame:
    """Add ``out``: a struct of the measurements and ``failed``, the bits of the failed rules."""

    def with_bits(m: Column) -> Column:
        bits = F.lit(0).cast("bigint")
        for i, rule in enumerate(RULES.values()):
            bits = bits + F.when(rule(lambda c: m[c]), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return F.struct(
            *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")],
            bits.alias("failed"),
        )

    return df.withColumn(out, bound(measurements(F.col(text_col)), with_bits))


def passes(policy: Policy, ledger_col: str = "ledger") -> Column:
    """Whether a document fails none of the rules that the policy enforces."""
    return F.col(ledger_col)["failed"].bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablation(df: DataFrame, policy: Policy = CURRENT, ledger_col: str = "ledger") -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that stay without it.

    Documents are first counted by their bits, at most one row per combination of rules.
    """
    masked = F.col(ledger_col)["failed"].bitwiseAND(F.lit(policy.mask).cast("bigint"))
    counts = df.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    none = df.sparkSession.range(1).select(F.col("id").alias("bits"), F.col("id").alias("n"))  # bits 0, no document
    names = list(RULES)
    rules = [F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("bigint").alias("bit")) for r in policy.rules]
    each = counts.unionByName(none).select("bits", "n", F.inline(F.array(*rules)))

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("bigint")

    return each.groupBy(F.lit(policy.version).alias("policy"), "rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("failed_alone"),
        total((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("kept_without"),
    )
