import datetime as dt

import pytest

from lakeloom.operators.asof import features_as_of, point_in_time_join

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2025, 6, 29)
FEATS = "c string, event_timestamp timestamp_ntz, created timestamp_ntz, f int"


def join(spark, labels, feats, **options):
    a = spark.createDataFrame(labels, "c string, label_time timestamp_ntz")
    b = spark.createDataFrame(feats, FEATS)
    return point_in_time_join(a, b, ["c"], "label_time", "event_timestamp", "created", **options)


def test_label_before_the_feature_sees_nothing(spark, rows):
    """Three labels, one of them before the feature: two rows out."""
    feats = [("C1", T0, T0, 14), ("C2", T0, T0, 13)]
    late, early = dt.datetime(2025, 9, 1), dt.datetime(2025, 5, 1)
    labels = [("C1", late), ("C2", late), ("C1", early)]
    got = join(spark, labels, feats, ttl="365 days")
    assert rows(got, "c", "label_time", "f") == [("C1", late, 14), ("C2", late, 13)]
    kept = join(spark, labels, feats, ttl="365 days", how="left")
    assert rows(kept, "c", "label_time", "f") == [("C1", early, None), ("C1", late, 14), ("C2", late, 13)]


def test_edges(spark, rows):
    feats = [("a", T0, T0, 1), ("a", T0, T0 + DAY, 2), ("a", T0 - DAY, T0 + 5 * DAY, 9), (None, T0, T0, 7)]
    labels = [("a", T0), ("a", T0 + 10 * DAY), ("a", T0 + 10 * DAY + dt.timedelta(seconds=1)), (None, T0), ("b", T0)]
    got = join(spark, labels, feats, ttl="10 days")
    # Equal time counts, the last created wins, the age limit is inclusive, NULL entities never match.
    assert rows(got, "c", "label_time", "feature_time", "f") == [("a", T0, T0, 2), ("a", T0 + 10 * DAY, T0, 2)]


def test_copies_of_a_label_stay(spark):
    got = join(spark, [("a", T0)] * 5, [("a", T0, T0, 1)])
    assert got.count() == 5


def test_against_brute_force_with_a_hot_entity(spark):
    feats, labels = [], []
    for i in range(600):
        c = "hot" if i % 3 == 0 else f"c{i % 11}"
        at = T0 + dt.timedelta(seconds=(i * 7919) % 500_000)
        feats.append((c, at, at + dt.timedelta(seconds=i % 5), i))
        labels.append((c, T0 + dt.timedelta(seconds=(i * 104_729) % 600_000)))
    ttl = dt.timedelta(days=1)
    got = {(r.c, r.label_time): r.f for r in join(spark, labels, feats, ttl="1 day", how="left").collect()}
    for c, at in labels:
        known = [(t, made, f) for k, t, made, f in feats if k == c and t <= at]
        want = max(known) if known else None
        want = want[2] if want and want[0] >= at - ttl else None
        assert got[c, at] == want


def test_static_lookup(spark, rows):
    feats = spark.createDataFrame([("a", T0, T0, 1), ("a", T0 + DAY, T0, 2), ("b", T0 + 9 * DAY, T0, 3)], FEATS)
    assert rows(features_as_of(feats, "event_timestamp", "2025-07-01"), "f") == [(1,), (2,)]
    assert rows(features_as_of(feats, "event_timestamp", "2025-07-01", ["c"], "created"), "f") == [(2,)]
