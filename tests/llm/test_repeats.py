import numpy as np
import pytest

from lakeloom.llm import repeats

SCHEMA = "doc_id bigint, text string, n_bytes string, id string"


def brute(rows):
    """doc_id -> (n_bytes, n_removed, n_spans, kept), over documents in the order of their ids."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        marks = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                marks[s : s + 100] = b"\1" * 100
            seen.add(window)
        runs = [x for x in bytes(marks).split(b"\0") if x]
        out[i] = (len(data), sum(marks), len(runs), bytes(c for c, m in zip(data, marks) if not m))
    return out


def removed(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    found = repeats.remove_repeats(frame).collect()
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in found]


def text(rng, n, letters="abcdefgh é\n"):
    return "".join(rng.choice(list(letters), n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.RandomState(6)
    shared = [text(rng, n) for n in (100, 101, 150, 400, 3000)]
    out = []
    for i in range(80):
        parts = [text(rng, rng.randint(0, 300))]
        for _ in range(rng.randint(0, 4)):
            s = shared[rng.randint(len(shared))]
            a = rng.randint(0, 60)
            parts += [s[a:], text(rng, rng.randint(0, 120))]
        out.append((i * 13 % 83, "".join(parts)))
    out += [(200, None), (201, ""), (202, "a" * 99), (203, "a" * 100), (204, "a" * 500), (205, "ab" * 400), (206, shared[4] * 3)]
    return out


def test_brute_force(spark, rows):
    assert dict(removed(spark, rows)) == brute(rows)


def test_small_pieces(spark, rows, monkeypatch):
    """Long texts in pieces, many small bins."""
    monkeypatch.setattr(repeats, "BIN_BYTES", 2000)
    assert dict(removed(spark, rows)) == brute(rows)
    long = [(1, text(np.random.RandomState(8), 200_000)), (2, text(np.random.RandomState(9), 5000))]
    long.append((3, long[0][1][60_000:140_000] + "x" + long[1][1][17:]))
    assert dict(removed(spark, long)) == brute(long)


def test_very_common_passage(spark, monkeypatch):
    """A passage in every document, whose segments are grouped by digest."""
    monkeypatch.setattr(repeats, "HOT", 5)
    rng = np.random.RandomState(10)
    passage = text(rng, 160)
    rows = [(i, text(rng, 50) + passage + text(rng, 50)) for i in range(60)] + [(100 + i, "same " * 60) for i in range(60)]
    assert dict(removed(spark, rows)) == brute(rows)


def test_repeated_rows_null_and_shared_ids(spark):
    a, b = text(np.random.RandomState(1), 300), text(np.random.RandomState(2), 300)
    found = removed(spark, [(5, a), (5, a), (9, a), (None, b), (4, b)])
    assert sorted((i or 0, r[1]) for i, r in found) == [(0, 0), (4, len(b.encode())), (5, 0), (5, 0), (9, len(a.encode()))]
    shared = removed(spark, [(5, a), (5, a + b), (6, b)])
    # Whichever text of id 5 comes first, one copy of each passage stays.
    assert sorted(r[1] for _, r in shared) == sorted([0, len(a.encode()), len(b.encode())])


def test_empty_table(spark):
    assert removed(spark, []) == []


def test_suffix_order():
    rng = np.random.RandomState(11)
    for _ in range(60):
        parts = [bytes(rng.randint(97, 97 + rng.randint(1, 4), rng.randint(1, 30)).astype(np.uint8)) for _ in range(rng.randint(1, 12))]
        lengths = np.array(list(map(len, parts)))
        starts = np.cumsum(lengths) - lengths
        known, prefix = repeats.suffix_order(np.frombuffer(b"".join(parts), np.uint8), starts, lengths)
        order = sorted(((p[o:], i, o) for i, p in enumerate(parts) for o in range(len(p) + 1)), key=lambda x: x[:2])
        assert known.tolist() == [int(starts[i] + o) for _, i, o in order]
        common = [0]
        for (x, *_), (y, *_) in zip(order, order[1:]):
            common.append(next((k for k, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y))))
        assert prefix.tolist() == common


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeated_rows_around_a_passage_in_other_surroundings(spark, monkeypatch, hot):
    """Slabs with equal inner bytes and different contents, of documents that come several times."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = np.random.RandomState(12)
    passage = text(rng, 180)
    rows = [(i, text(rng, 90) + passage + text(rng, 90)) for i in range(6)]
    found = removed(spark, rows + rows[:3] + rows[:1] * 5)
    assert len(found) == 14 and dict(found) == brute(rows)
    assert all(r == dict(found)[i] for i, r in found)
