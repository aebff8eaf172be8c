"""Empty days, NULL ids and amounts, odd white space, late snapshots, shared folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from lakeloom.operators.aggregates import dup_rate, rate, share_of_top
from lakeloom.operators.drift import psi
from lakeloom.operators.history import scd2, scd2_start
from lakeloom.operators.joins import BROADCAST_BYTES, hot_keys, small_ones
from lakeloom.operators.ordering import extend_keys
from lakeloom.plans import gold
from lakeloom.session import shared_dir
from lakeloom.sources.messages import decode_json
from lakeloom.sources.readers import read_lines


def test_rates_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id bigint")
    assert df.select(rate(F.col("id") > 0), dup_rate("id")).first() == (None, None)
    assert share_of_top(df, "id", 3).first()[0] is None


def test_drift_without_current_values(spark):
    base = spark.range(100).select(F.col("id").cast("double").alias("v"))
    rows = psi(base, base.filter("v < 0"), "v").collect()
    assert len(rows) == 10 and all(r.cur_rows == 0 and r.drifted for r in rows)
    assert psi(base.filter("v < 0"), base, "v").count() == 1


def test_extend_keys_leaves_null_ids_out(spark):
    old = spark.createDataFrame([(1, "a")], "k bigint, id string")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    once = extend_keys(df, old, "id", "k")
    twice = extend_keys(df, once, "id", "k")
    assert sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "b")]


def test_white_space_and_fractions_in_json(spark, tmp_path):
    schema = StructType([StructField("a", LongType()), StructField("t", TimestampNTZType())])
    lines = ["\t", "\t{\"a\": 1}\r", " \x0b ", '{"a": 2, "t": "2025-01-01T00:00:00.123456789"}', "x"]
    good, bad = decode_json(spark.createDataFrame([(x,) for x in lines], "v string"), "v", schema)
    assert sorted((r.a, r.t) for r in good.collect())[0] == (1, None)
    assert [r.a for r in good.orderBy("a").collect()] == [1, 2]
    assert good.filter("a = 2").first().t == dt.datetime(2025, 1, 1, 0, 0, 0, 123456)
    assert [r.v for r in bad.collect()] == ["x"]
    (tmp_path / "f.txt").write_text("\t\n a \t\n")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ["a"]


def test_old_snapshots_do_not_touch_newer_versions(spark):
    first = spark.createDataFrame([(1, "x")], "id bigint, v string")
    history = scd2_start(first, ["id"], ["v"], "2025-02-01 00:00:00")
    older = scd2(history, spark.createDataFrame([(1, "y")], "id bigint, v string"), ["id"], ["v"], "2025-01-01 00:00:00")
    assert [(r.v, r.valid_to, r.is_current) for r in older.collect()] == [("x", None, True)]


@pytest.mark.parametrize(
    "column",
    [
        "array_repeat(1.0D, 100000)",
        "array_repeat('word', 30000)",
        "map('k', repeat('x', 200000))",
        "struct(repeat('x', 200000) AS s)",
        "repeat('x', 200000) COLLATE UNICODE_CI",
    ],
)
def test_nested_and_collated_columns_are_measured(spark, column):
    assert small_ones([spark.range(100).select("id", F.expr(column).alias("c"))]) == [False]
    assert small_ones([spark.range(1).select("id", F.expr(column).alias("c"))]) == [True]


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_hot_keys_are_looked_for_before_any_join(spark, monkeypatch):
    from lakeloom.operators import joins

    seen = []
    monkeypatch.setattr(joins, "small_ones", lambda frames, limit=BROADCAST_BYTES: [False] * len(frames))
    monkeypatch.setattr(joins, "hot_keys", lambda df, groups, share=0.01: seen.append(_joins(df)) or hot_keys(df, groups, share))
    items = spark.createDataFrame(
        [(i, i % 5, i % 3, "S", 1, 1.0, 0.0, 1.0) for i in range(30)],
        "order_item_id bigint, order_id bigint, product_id bigint, size string, quantity bigint, unit_price double, discount_amount double, line_amount double",
    )
    orders = spark.createDataFrame([(i, 7, dt.date(2025, 1, 1)) for i in range(4)], "order_id bigint, customer_id bigint, order_date date")
    products = spark.createDataFrame([(i, i, "c") for i in range(3)], "product_id bigint, product_key bigint, category string")
    assert gold.fact_order_items(items, orders, products).count() == 24
    assert gold.customer_features(orders, items, products).count() == 1
    assert seen and set(seen) == {0}


def test_average_order_value_leaves_out_orders_without_an_amount(spark):
    items = spark.createDataFrame([(1, 1, 10.0), (2, 1, None)], "order_id bigint, product_id bigint, line_amount double")
    orders = spark.createDataFrame([(i, 7, dt.date(2025, 1, 1)) for i in (1, 2)], "order_id bigint, customer_id bigint, order_date date")
    products = spark.createDataFrame([(1, "c")], "product_id bigint, category string")
    row = gold.customer_features(orders, items, products).first()
    assert (row.f_total_orders_90d, row.f_avg_order_value_90d) == (2, 10.0)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        shared_dir(Session())
