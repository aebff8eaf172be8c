import hashlib
from collections import defaultdict

import pytest

from lakeloom.llm import sharding

SCHEMA = "doc_id bigint, text string, name string, shard string"


def bits(doc_id):
    digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    return format(int(digest[:15], 16), "060b")


def brute(rows, limit):
    """doc_id -> name of the shard, by splitting bucket after bucket."""
    done, todo = {}, [("", [(bits(i), i, len((t or "").encode())) for i, t in rows])]
    while todo:
        prefix, bucket = todo.pop()
        if sum(n for *_, n in bucket) <= limit:
            done |= {i: prefix for _, i, _ in bucket}
        else:
            for bit in "01":
                part = [b for b in bucket if b[0][len(prefix)] == bit]
                todo.append((prefix + bit, part))
    return done


def assigned(spark, rows, limit):
    frame = spark.createDataFrame([(i, t, "n", "s") for i, t in rows], SCHEMA)
    return [(r.doc_id, r.shard.name, r.shard.depth, r.shard.bytes) for r in sharding.assign(frame, limit).collect()]


@pytest.mark.parametrize("limit", [50, 200, 1000, 10**9])
def test_brute_force(spark, limit):
    rows = [(i, "é" * (i * 7 % 23)) for i in range(400)] + [(1000, None), (1001, "")]
    got = {i: name for i, name, _, _ in assigned(spark, rows, limit)}
    assert got == brute(rows, limit)


def test_deep_splits(spark, monkeypatch):
    """Buckets that the first aggregation does not split far enough."""
    monkeypatch.setattr(sharding, "SLACK", 0)
    monkeypatch.setattr(sharding, "MORE", 1)
    rows = [(i, "x" * (40 if bits(i).startswith("01") else 1)) for i in range(600)]
    got = {i: name for i, name, _, _ in assigned(spark, rows, 100)}
    assert got == brute(rows, 100)


def test_hot_id_and_large_documents(spark):
    """A third of all rows have one id; some documents exceed half of the limit or the limit."""
    rows = [(7, "x" * 30)] * 200 + [(i, "y" * 10) for i in range(100, 500)] + [(7, "z" * 70), (900, "w" * 250)]
    sizes, names = defaultdict(int), defaultdict(list)
    found = assigned(spark, rows, 100)
    for i, name, depth, n in found:
        sizes[name] += n
        names[name].append((i, depth))
    assert len(found) == len(rows)
    assert all(n <= 100 or len(names[name]) == 1 for name, n in sizes.items())
    assert {d for i, _, d, _ in found if i in (7, 900)} == {-1}


def test_null_id_repeated_rows_and_empty_table(spark):
    found = assigned(spark, [(None, "a"), (None, "a"), (3, "b")], 1000)
    assert sorted(x[1] for x in found) == ["", "", ""]
    assert assigned(spark, [], 10) == []


def test_written_shards(spark, tmp_path):
    rows = [(i, "x" * 20) for i in range(100)]
    frame = spark.createDataFrame([(i, t, "n", "s") for i, t in rows], SCHEMA).drop("shard")
    sharding.write_shards(sharding.assign(frame, 300), str(tmp_path / "out"))
    folders = {p.name.split("=")[1] for p in (tmp_path / "out").glob("shard=*")}
    assert folders == set(brute(rows, 300).values())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
