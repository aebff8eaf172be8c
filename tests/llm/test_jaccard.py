"""The n-gram Jaccard join against all pairs."""

import random
from fractions import Fraction

import numpy as np
import pytest

from lakeloom.llm import jaccard

SCHEMA = "doc_id long, text string, source string"


def grams(text, size=jaccard.WORDS):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=jaccard.WORDS, num=85):
    sets = [(r[0], grams(r[1], size)) for r in rows]
    root = {i: i for i in range(len(rows))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for j in range(i):
            b, y = sets[j]
            if a is None or b is None or not x or not y:
                continue
            k = len(x & y)
            if 100 * k >= num * (len(x) + len(y) - k):
                root[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(sets):
        if a is not None:
            least[find(i)] = min(a, least.get(find(i), a))
    return sorted(((a, len(x), None if a is None else least[find(i)]) for i, (a, x) in enumerate(sets)), key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in jaccard.similar_documents(df, **kw).collect()), key=str)


def corpus(seed, groups=25):
    """Groups of texts that differ by a few words, around the threshold, with copies, stubs and NULLs."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, shared = [], rng.choices(vocab, k=60)
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.choice([3, 5, 8, 20, 60, 150, 400, 900]))
        if rng.random() < 0.3:
            base = base[: len(base) // 2] + shared + base[len(base) // 2 :]
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, len(text) // 60, len(text) // 40, len(text) // 25])):
                at = rng.randrange(len(text) + 1)
                if rng.random() < 0.5:
                    text[at : at + 1] = [rng.choice(vocab)]
                else:
                    text.insert(at, rng.choice(vocab))
            rows.append(("  ".join(t.upper() if rng.random() < 0.1 else t for t in text) + rng.choice(["", "\n", "\t "])))
    rows += [None, "", " \n ", "one", "ONE ", "a b c d e"]
    rng.shuffle(rows)
    return [(i, t, "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 4), (3, 1)])
def test_against_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(seed)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ids_with_several_texts_nulls_and_repeats(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(rng.choices([f"v{i}" for i in range(300)], k=120)) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (7, b + " more"), (9, b), (9, b), (None, a), (None, None), (12, c), (12, c + " x"), (3, c + " y"), (20, b + " again")]
    rows = [(*r, "s") for r in rows]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_near_copies_around_one_text(spark):
    """Copies of copies: neighbours are similar, far ones are not, and all are one component."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    text, rows = rng.choices(vocab, k=200), []
    for i in range(150):
        rows.append((1000 - i, " ".join(text), "s"))
        text = list(text)
        text[rng.randrange(len(text))] = rng.choice(vocab)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_passage_that_many_share(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(900)]
    shared = rng.choices(vocab, k=160)
    rows = [(i, " ".join(shared + rng.choices(vocab, k=rng.choice([12, 20, 40]))), "s") for i in range(120)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table_and_further_columns(spark):
    assert jaccard.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(*r, 1, 2, "x") for r in corpus(5, 6)]
    wide = spark.createDataFrame(rows, SCHEMA + ", id long, node long, class string")
    assert got(wide) == brute(rows)


def test_one_long_text(spark):
    rng = random.Random(8)
    text = rng.choices([f"w{i}" for i in range(5000)], k=60_000)
    near = list(text)
    for at in range(0, len(near), 100):
        near[at] = "other"
    rows = [(2, " ".join(text), "s"), (1, " ".join(near), "s"), (3, "short text of a few words", "s")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_pigeonhole_on_random_sets():
    """Whatever pair reaches the similarity: the chosen credits always leave a shared key."""
    rng = np.random.RandomState(3)
    t = jaccard.SIMILARITY
    for n in [1, 2, 5, 6, 7, 13, 40, 133, 400, 1500]:
        for _ in range(20):
            r = np.unique(rng.randint(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            out = rng.randint(0, max(1, int(n * 0.1)) + 1)
            extra = rng.randint(0, 2**63, rng.randint(0, max(1, int(n * 0.17)) + 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            s = np.unique(np.concatenate([rng.permutation(r)[out:], extra]))
            small, large = sorted((r, s), key=len)
            both = len(np.intersect1d(small, large))
            if not len(small) or Fraction(both, len(small) + len(large) - both) < t:
                continue
            band = jaccard.band_of(len(small), t)
            k1, _ = jaccard.keys_of(small, band, t)
            k2, of = jaccard.keys_of(large, band, t)
            hit = np.isin(k2, k1)
            double = jaccard.plan(band, t)[1]
            credit = sum(2 if x < double else 1 for x in set(of[hit].tolist()))
            # Even when every segment with a shared key is left out, the spare credits do not suffice.
            assert credit > jaccard.spare_credits(len(large), band, t)


def test_fingerprints_never_exceed_the_difference():
    rng = np.random.RandomState(5)
    for cells in (1, 2, 64, 256):
        a, b = (np.unique(rng.randint(0, 2**63, 100).astype(np.uint64) * np.uint64(2)) for _ in range(2))
        b = np.unique(np.concatenate([a[10:], b[:15]]))
        apart = np.count_nonzero(jaccard.fingerprint(a, cells) != jaccard.fingerprint(b, cells))
        assert apart <= len(np.setxor1d(a, b))
