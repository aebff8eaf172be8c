import datetime as dt

from lakeloom.operators.history import scd2, scd2_start, upsert

D1, D2, D3 = (dt.datetime(2025, 1, d) for d in (1, 2, 3))


def test_upsert(spark, rows):
    cur = spark.createDataFrame([(1, "a", D2), (2, "b", D2)], "k int, v string, t timestamp_ntz")
    new = spark.createDataFrame([(1, "old", D1), (2, "tie", D2), (3, "c", D1), (3, "d", D3)], "k int, v string, t timestamp_ntz")
    assert rows(upsert(cur, new, ["k"], ["t"]), "k", "v") == [(1, "a"), (2, "tie"), (3, "d")]
    assert rows(upsert(cur, new.filter("k = 1"), ["k"]), "k", "v") == [(1, "old"), (2, "b")]


def test_scd2_over_three_snapshots(spark, rows):
    def snap(*data):
        return spark.createDataFrame(data, "k string, tier string")

    history = scd2_start(snap(("a", "none"), ("b", None)), ["k"], ["tier"], "2025-01-01")
    history = scd2(history, snap(("a", "gold"), ("b", None), ("c", "new")), ["k"], ["tier"], "2025-01-02")
    assert rows(history, "k", "tier", "valid_from", "valid_to", "is_current") == [
        ("a", "gold", D2, None, True),
        ("a", "none", D1, D2, False),
        ("b", None, D1, None, True),
        ("c", "new", D2, None, True),
    ]
    last = snap(("a", "gold"), ("b", "set"))
    kept = scd2(history, last, ["k"], ["tier"], "2025-01-03")
    assert rows(kept.filter("is_current"), "k", "tier") == [("a", "gold"), ("b", "set"), ("c", "new")]
    closed = scd2(history, last, ["k"], ["tier"], "2025-01-03", close_missing=True)
    assert rows(closed.filter("is_current"), "k", "tier") == [("a", "gold"), ("b", "set")]
    assert rows(closed.filter("k = 'c'"), "valid_from", "valid_to") == [(D2, D3)]
    # The same snapshot again changes nothing.
    assert rows(scd2(closed, last, ["k"], ["tier"], "2025-01-04")) == rows(closed)
