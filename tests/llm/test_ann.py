import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def found(spark, rows, k, every=5, **kw):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    out = {}
    for r in ann.search(frame, F.col("vec_id") % every == 0, k, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def brute(rows, k, every=5):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in good:
        if q % every == 0:
            scores = sorted((-(x * v).sum(), i) for i, v in good if i != q)[:k]
            out[q] = [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return out


def vectors(n, dim=16, seed=0):
    x = np.random.RandomState(seed).randn(n, dim)
    return (x / np.linalg.norm(x, axis=1)[:, None]).tolist()


def test_all_cells_is_brute_force(spark):
    rows = list(enumerate(vectors(200)))
    assert found(spark, rows, 7, share=1.0) == brute(rows, 7)


def test_recall(spark):
    rows = list(enumerate(vectors(1500)))
    got, best = found(spark, rows, 10), brute(rows, 10)
    recall = np.mean([len({i for _, i, _ in got[q]} & {i for _, i, _ in best[q]}) / 10 for q in best])
    assert recall >= 0.9 and all(len(v) == 10 for v in got.values())
    scores = {(q, i): s for q, rows_ in got.items() for _, i, s in rows_}
    exact = dict(rows)
    for (q, i), s in list(scores.items())[:500]:
        assert s == (np.array(exact[i], np.float32).astype(float) * np.array(exact[q], np.float32).astype(float)).sum()


def test_unusable_vectors_ties_and_repeated_rows(spark, monkeypatch):
    """A very common vector fills several blocks; equal scores go to smaller ids."""
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "QUERIES", 8)
    x = vectors(60)
    rows = [(i, x[0] if i % 3 else x[i % 60]) for i in range(300)]
    rows += [(1000, None), (1005, [0.0] * 16), (1010, [float("nan")] + x[0][1:]), (1015, [None] + x[0][1:]), (1020, [float("inf")] + x[0][1:])]
    rows += [(1025, x[0][:8]), (None, x[1])]
    kept = [r for r in rows if r[0] != 1025]
    assert found(spark, rows, 6, share=1.0) == brute(kept, 6)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = list(enumerate(vectors(n)))
    assert {q: v for q, v in found(spark, rows, 20, every=1).items()} == {q: v for q, v in brute(rows, 20, 1).items() if v}


def test_traversal_is_in_falling_order():
    rng = np.random.RandomState(2)
    left, right = rng.randn(9), rng.randn(7)
    counts = rng.randint(0, 4, (9, 7))
    cells, floor = ann.visited(left, right, counts.tolist(), 40)
    sums = (left[:, None] + right[None, :]).ravel()
    order = [c for c in np.argsort(-sums, kind="stable") if counts.ravel()[c]]
    held = np.cumsum(counts.ravel()[order])
    assert cells.tolist() == order[: int(np.searchsorted(held, 40)) + 1] and floor == sums[cells[-1]]
