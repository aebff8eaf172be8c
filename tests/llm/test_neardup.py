import random
import re

import numpy as np
import pytest

from lakeloom.llm import neardup
from lakeloom.llm.components import components

SCHEMA = "doc_id bigint, text string, root string, kept string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (n_shingles, component, kept), all pairs compared."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def judged(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame).collect()}


def changed(words, rate, seed):
    rng = np.random.RandomState(seed)
    return [f"new{seed}x{i}" if rng.rand() < rate else w for i, w in enumerate(words)]


def test_brute_force(spark):
    rng = np.random.RandomState(3)
    rows = []
    for group in range(25):
        words = [f"w{rng.randint(400)}" for _ in range(rng.randint(3, 200))]
        for copy in range(rng.randint(1, 6)):
            rows.append((len(rows) * 7 % 1009, " ".join(changed(words, rng.choice([0, 0.01, 0.03, 0.05, 0.1]), len(rows)))))
    rows += [(2000, ""), (2001, None), (2002, " \t\n"), (2003, "one two"), (2004, "One\ttwo"), (2005, "one  TWO three")]
    assert judged(spark, rows) == brute(rows)


def test_large_group_and_shared_passage(spark):
    """Hundreds of near copies, and documents that share half of their words but are no copies."""
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(changed(base, 0.01, i))) for i in range(300)]
    half = [f"h{i}" for i in range(60)]
    rows += [(1000 + i, " ".join(half + [f"d{i}x{k}" for k in range(25)])) for i in range(80)]
    rows += [(1500 + i, " ".join(half + [f"d{i}x{k}" for k in range(25)] + ["end"])) for i in range(0, 80, 4)]
    assert judged(spark, rows) == brute(rows)


def test_blocks_find_links_beyond_the_leader(spark, monkeypatch):
    """Pairs in a bucket whose smallest member is linked with neither, with small blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    half = [f"h{i}" for i in range(60)]
    rows = []
    for i in range(20):
        own = [f"d{i}x{k}" for k in range(30)]
        rows += [(2 * i, " ".join(half + own)), (2 * i + 1, " ".join(half + own + ["more"]))]
    assert judged(spark, rows) == brute(rows)


def test_blocks_let_few_unlike_pairs_of_a_large_group_through(spark, monkeypatch):
    """Variants of one text, similar by about 0.6: the pairs that leave the blocks do not grow with the square."""
    seen, check = [], neardup.confirmed
    monkeypatch.setattr(neardup, "confirmed", lambda pairs, *a: seen.append(pairs.count()) or check(pairs, *a))
    base = [f"b{i}" for i in range(200)]
    rng = random.Random(5)
    rows = []
    for i in range(200):
        own = list(base)
        for at in rng.sample(range(200), 5):
            own[at] = f"d{i}x{at}"
        rows.append((i, " ".join(own)))
    rows += [(500, rows[7][1] + " end"), (501, rows[9][1] + " end")]
    assert judged(spark, rows) == brute(rows)
    assert sum(seen[1:]) < 400


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(5, text, "", ""), (5, text, "", ""), (None, text, "", ""), (9, text, "", "")], SCHEMA)
    rows = sorted(neardup.near_duplicates(frame).collect(), key=str)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id) == [(5, 5, True), (5, 5, True), (9, 5, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimate_follows_similarity():
    rng = np.random.RandomState(0)
    pool = rng.randint(0, 2**62, 3000).astype(np.uint64)
    for share in (0.3, 0.6, 0.75, 0.9):
        errors = []
        for k in range(40):
            picked = rng.permutation(pool)[:800]
            both = int(2 * 400 * share / (1 + share))
            a, b = picked[:400], np.concatenate([picked[:both], picked[400 : 800 - both]])
            x, y = (neardup.packed(neardup.minima(s)).view(np.uint64) for s in (a, b))
            differ = x ^ y
            differ |= differ >> np.uint64(1)
            equal = 1 - np.bitwise_count(differ & np.uint64(neardup._LOWEST)).sum() / neardup.PERMUTATIONS
            errors.append((equal - 0.25) / 0.75 - both / (800 - both))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (9, 8), (7, 9)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(4, 4)], []])
def test_components(spark, links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for n in root}


def test_ids_with_several_texts_keep_their_links(spark):
    """A near copy of the second text of an id is linked through it."""
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(400)]
    a, b = (" ".join(rng.choices(vocab, k=90)) for _ in range(2))
    rows = [(1, a), (5, a), (5, b), (7, b + " more"), (9, b)]
    got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # 5 has two texts: one reaches 1, the other is the smallest of its own component.
    assert got == {(1, 1, True), (5, 1, False), (5, 5, True), (7, 5, False), (9, 5, False)}
    kept = neardup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == sorted([(1, a), (5, b)])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables_with_repeated_ids(spark, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    bases = [rng.choices(vocab, k=rng.choice([4, 30, 80])) for _ in range(8)]
    rows = []
    for _ in range(60):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice(vocab)
        rows.append((rng.choice([None, *range(25)]), " ".join(text)))
    rows += rows[:5]
    sets = [set(neardup.shingle_hashes(neardup.words(t)).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if None not in (rows[i][0], rows[j][0]) and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[find(i)] = min(id_, least.get(find(i), id_))
    want = sorted((str(id_), len(s), str(None if id_ is None else least[find(i)])) for i, ((id_, _), s) in enumerate(zip(rows, sets)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in neardup.near_duplicates(df).collect())
    assert got == want
    # One row of each component stays, and all rows without an id.
    kept = neardup.one_of_each(df)
    groups = {least[find(i)] if id_ is not None else None: 0 for i, (id_, _) in enumerate(rows)}
    assert kept.filter("doc_id IS NOT NULL").count() == len({find(i) for i, (id_, _) in enumerate(rows) if id_ is not None})
    assert kept.filter("doc_id IS NULL").count() == sum(id_ is None for id_, _ in rows) and groups


def test_the_row_that_stays_is_the_same_for_any_partitioning(spark):
    rows = [(1, "one text of some words to keep", s) for s in ("z", "b", "c")] + [(2, "one text of some words to keep", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {tuple(r) for n in (1, 3, 7) for r in neardup.one_of_each(df.repartition(n)).collect()} == {(1, rows[0][1], "b")}
