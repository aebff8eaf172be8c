"""The queries on data where one key holds a third of the rows, with every broadcast refused."""

import pytest

import __spark_entry__ as entry
from lakeloom.operators import joins

from .compare import DATA, TABLES, differences, duck

SKEWED = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 5 ELSE o_custkey END AS o_custkey)",
    # A third of the lines in one order, so also a third in seven line ids; another third one product.
    "lineitem": """* REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
                              CASE WHEN l_suppkey % 3 = 1 THEN 11 ELSE l_partkey END AS l_partkey)""",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id)",
}
NAMES = (
    "order_wide top_stores fact_orders fact_order_items customer_90d_line customer_90d_order historical_features "
    "historical_features_left dedup_items dedup_report keys_without_rows attempt_sequence rolling_60m latest_per_key "
    "materialize_latest dq_referential dq_reconcile stream_profile scd2 unified_features training_set failure_rate_90d "
    "log_rollup index_coverage payment_attempts time_split"
).split()


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duck(f"{DATA}/sf0.001")
    for name in TABLES:
        con.execute(f"COPY (SELECT {SKEWED.get(name, '*')} FROM {name}) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.fixture(scope="module")
def con(skewed_dir):
    return duck(skewed_dir)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, con, skewed_dir, monkeypatch, name):
    monkeypatch.setattr(joins, "small_ones", lambda frames, limit=0: [False] * len(frames))
    got = entry.queries()[name](spark, skewed_dir)
    assert differences(got, con.sql(entry.oracle_sql()[name])) is None
