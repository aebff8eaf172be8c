import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import (
    amount,
    calendar_columns,
    date_key,
    exact_sum,
    hours_in,
    in_hours,
    line_amount,
    mapped,
    mask_email,
    mean_half_up,
    net_cents,
    padded_id,
    plus_seconds,
    seconds_between,
)


def test_mask_keeps_two_characters_and_survives_bad_addresses(spark):
    df = spark.createDataFrame([("user1@x.test",), ("a@b.c",), ("no-at",), (None,)], "e string")
    got = [r[0] for r in df.select(mask_email("e")).collect()]
    assert got == ["us***@x.test", "a@***@b.c", None, None]


def test_money_sums_do_not_drift(spark):
    df = spark.createDataFrame([(0.1,)] * 3 + [(-0.3,), (None,)], "v double")
    assert df.select(exact_sum("v", 2)).first()[0] == 0.0


@pytest.mark.parametrize(
    ("total", "places", "want"), [(125, 1, 1.3), (-125, 1, -1.3), (124, 1, 1.2), (150, 0, 2.0), (149, 0, 1.0), (7, 2, 0.07)]
)
def test_amount_rounds_half_away_from_zero(spark, total, places, want):
    assert spark.range(1).select(amount(F.lit(total), places)).first()[0] == want


def test_mean_rounds_as_exact_decimals_do(spark):
    cases = [(c, n) for c in (0, 1, 5, 15, 25, 12345, 99995, 10**12 + 5) for n in (1, 2, 3, 4, 7, 8)]
    df = spark.createDataFrame(cases, "c bigint, n bigint")
    for c, n, got in df.select("c", "n", mean_half_up("c", "n")).collect():
        exact = (Decimal(c) / 100 / n).quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert got == float(exact), (c, n)
    assert spark.range(1).select(mean_half_up(F.lit(5), F.lit(0))).first()[0] is None


def test_net_amount_and_line_amount(spark):
    df = spark.createDataFrame([(65.0, 2, 1.2, 0.2), (45.5, 3, 1.4, 0.0), (33.3, 1, 1.0, 0.2)], "p double, q long, f double, d double")
    got = [tuple(r) for r in df.select(*line_amount("p", "q", "f", "d")).collect()]
    assert got == [(78.0, 31.2, 124.8), (63.7, 0.0, 191.1), (33.3, 6.7, 26.6)]
    assert spark.range(1).select(net_cents(F.lit(10.05), F.lit(0.05))).first()[0] == 955


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 2),), (dt.date(2025, 3, 3),)], "d date")
    first, second = df.select(*calendar_columns("d")).collect()
    assert (first.date_key, first.day_of_week, first.is_weekend) == (20250302, "Sunday", True)
    assert (second.year, second.month, second.day, second.is_weekend) == (2025, 3, 3, False)
    assert df.select(date_key("d")).first()[0] == 20250302


def test_hour_windows_leave_out_the_end(spark):
    assert hours_in(["07:00-09:00", "12:00-13:00"]) == {7, 8, 12}
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, h),) for h in (6, 7, 8, 9, 12)], "t timestamp_ntz")
    assert [r[0] for r in df.select(in_hours("t", ["07:00-09:00"])).collect()] == [False, True, True, False, False]


@given(st.lists(st.tuples(st.integers(0, 22), st.integers(1, 23)), max_size=4))
def test_hour_windows_cover_each_hour_once(windows):
    """A window that ends before it starts goes on over midnight."""
    texts = [f"{a:02d}:00-{b:02d}:00" for a, b in windows]
    assert hours_in(texts) == {h % 24 for a, b in windows for h in range(a, b if b >= a else b + 24)}


@pytest.mark.parametrize("window", ["07:30-09:00", "7-9", "25:00-26:00", ""])
def test_other_windows_are_refused(window):
    with pytest.raises(ValueError):
        hours_in([window])


def test_small_amounts_add_up(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert df.select(exact_sum("v", 2)).first()[0] == 4.0
    assert spark.range(3).select(exact_sum(F.lit(1e12), 2)).first()[0] == 3e12


def test_whole_numbers_are_not_divided_by_way_of_double(spark):
    assert spark.range(1).select(amount(F.lit(900719925474099377), 1)).first()[0] == 90071992547409938 / 10


def test_lookup_with_default_and_ids(spark):
    df = spark.createDataFrame([("S",), ("X",), (None,)], "s string")
    assert [r[0] for r in df.select(mapped("s", {"S": 1.0, "M": 1.2}, 9.0)).collect()] == [1.0, 9.0, 9.0]
    assert spark.range(1).select(padded_id("PAY", 9, F.lit(42))).first()[0] == "PAY000000042"


def test_time_arithmetic(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1), 3601)], "t timestamp_ntz, s long")
    later = df.withColumn("u", plus_seconds("t", "s"))
    assert later.first().u == dt.datetime(2025, 1, 1, 1, 0, 1)
    assert later.select(seconds_between("t", "u")).first()[0] == 3601
