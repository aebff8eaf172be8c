"""Source divergence against a plain count in Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeloom.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=divergence.MIN_DOCS, top=divergence.TOP_TERMS):
    count, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall(lowered(text or ""))
        count[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) * (x - y) // (x + y)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                limit = top if part == "term" else len(items)
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:limit], 1)]
    return sorted(out)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "Bc", "éß", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "x" * 40, "日本語テキスト", "日本語テキストの長い語", "Zz", "zz"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "0", ", ", "[", "`"]) for _ in range(rng.randint(0, 30)))
        rows.append((i, rng.choice([text, text, text, None, ""]), rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "É", None]), 1))
    return rows


@pytest.mark.parametrize("seed,portion", [(1, 1 << 22), (2, 300), (3, 40)])
def test_against_brute_force(spark, seed, portion):
    rows = random_rows(seed)
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), portion=portion)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_many_sources_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "CELLS", 20)
    rows = [(i, f"common word{i % 5}" + " rare" * (i % 7), "en", f"s{i % 11}", 1) for i in range(200)]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_language_that_keeps_no_term(spark):
    rows = [(1, "one", "xx", "a", 1), (2, None, "xx", "b", 1), (3, "two", "yy", None, 1)]
    got = sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]


def test_empty_table_and_further_columns(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame([(*r, 7, 8, 9) for r in random_rows(5)], SCHEMA + ", term string, n long, rank int".replace("term string", "term long"))
    assert sorted(tuple(r) for r in divergence.audit(wide).collect()) == brute(random_rows(5))


def test_a_term_longer_than_a_portion():
    text = np.frombuffer(b"ab " + b"q" * 1000 + b" cd " * 50, np.uint8)
    found = divergence._of_long(text, 64).to_pydict()
    assert dict(zip(found["term"], found["n"])) == {"ab": 1, "q" * 1000: 1, "cd": 50}


def test_shares_are_exact_for_large_counts():
    totals = np.array([8_999_999_999_999_000, 7], dtype=np.int64)
    counts = np.array([[4_499_999_999_999_500, 3]], dtype=np.int64)
    want = [1 + 10**9 * (int(c) + 2) // (int(n) + 10) for c, n in zip(counts[0], totals)]
    assert divergence.shares(counts, totals, 5).tolist() == [want]
    with pytest.raises(OverflowError):
        divergence.shares(counts, totals + 10**15, 5)
