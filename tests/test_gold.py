import datetime as dt

import pytest

from lakeloom.plans import gold, serving
from lakeloom.plans.layers import build_silver
from lakeloom.plans.payments import numbered, payment_base
from lakeloom.plans.views import CUSTOMER_90D, FeatureView, export_features, historical_features, materialize, online_lookup, refresh_online

from . import retail


@pytest.fixture(scope="module")
def clean(spark):
    return build_silver(retail.tables(spark))


@pytest.fixture(scope="module")
def built(clean):
    return gold.build_gold(clean)


def test_silver_cleans(clean, rows):
    assert clean["order_items"].count() == 6
    assert rows(clean["customers"], "customer_id", "city") == [("C1", "Hue"), ("C2", "unknown")]
    assert dict(clean["orders"].dtypes)["order_date"] == "date"
    assert "events" not in clean


def test_dimensions(built, rows):
    assert rows(built["dim_customer"], "customer_key", "customer_id", "email_masked") == [
        (1, "C1", "an***@x.test"),
        (2, "C2", "bo***@x.test"),
    ]
    assert "full_name" not in built["dim_customer"].columns and "email" not in built["dim_customer"].columns
    assert rows(built["dim_employee"], "employee_key", "role") == [(1, "barista"), (2, "manager")]
    assert built["dim_date"].count() == 4


def test_full_calendar_fills_gaps(clean):
    some = clean["orders"].filter("order_id IN ('O1', 'O4')")
    assert gold.dim_date(some).count() == 2
    assert gold.dim_date(some, full=True).count() == 4
    assert gold.dim_date(some.filter("false"), full=True).count() == 0


def test_fact_orders(built, rows):
    assert rows(built["fact_orders"], "order_id", "customer_key", "store_key", "order_date_key", "item_count", "order_net_amount") == [
        ("O1", 1, 1, 20250330, 3, 245.8),
        ("O2", 1, 1, 20250331, 1, 180.0),
        ("O3", None, 2, 20250401, 1, 65.0),
        ("O4", 2, 2, 20250402, None, None),
        ("O5", 1, 1, 20250402, 1, 10.0),
    ]


def test_fact_items_keep_unknown_products(built, rows):
    assert rows(built["fact_order_items"], "order_item_id", "product_key") == [
        ("I1", 1), ("I2", 2), ("I3", 1), ("I4", 3), ("I5", 1), ("I6", None),
    ]


def test_wide_table(built, rows):
    assert rows(built["obt_order_performance"], "order_id", "customer_city", "region", "payment_status_last", "payment_method_last") == [
        ("O1", "Hue", "North", "success", "card"),
        ("O2", "Hue", "North", None, None),
        ("O3", None, "Central", "success", "cash"),
        ("O4", "unknown", "Central", None, None),
        ("O5", "Hue", "North", None, None),
    ]


def test_unknown_ids_show_as_null_in_the_wide_table(clean, rows):
    wide = gold.order_wide(clean["orders"], customers=clean["customers"].filter("customer_id = 'C2'"))
    assert rows(wide, "order_id", "customer_id")[0] == ("O1", None)


def features(clean, **options):
    df = gold.customer_features(clean["orders"], clean["order_items"], clean["products"], **options)
    return [tuple(r)[2:] for r in df.filter("customer_id = 'C1'").collect()]


def test_average_is_weighted_by_lines_or_by_orders(clean):
    # O1 has three listed lines (245.8), O2 one (180.0); the only line of O5 has no product.
    assert features(clean) == [(2, 229.4, 3)]  # (3 * 245.8 + 180) / 4 = 229.35
    assert features(clean, grain="order") == [(2, 212.9, 3)]


def test_window_and_stamp(clean, spark):
    # One day back from 31 March leaves out 30 March and everything after the reference day.
    assert features(clean, ref="2025-03-31", days=1) == [(1, 180.0, 1)]
    assert features(clean, ref="2025-03-31", days=90) == [(2, 229.4, 3)]
    assert features(clean, status="cancelled") == []
    for stamp, day in (("start", 31), ("end", 32)):
        df = gold.customer_features(clean["orders"], clean["order_items"], clean["products"], ref="2025-03-31", stamp=stamp)
        assert df.first().event_timestamp == dt.datetime(2025, 3, 1) + dt.timedelta(days=day - 1)
    with pytest.raises(ValueError):
        features(clean, grain="week")


def test_reports(built, rows):
    wide, feats = built["obt_order_performance"], built["feat_customer_90d"]
    assert [tuple(r) for r in serving.revenue_by_region(wide).collect()] == [("North", 2, 426.0), ("Central", 1, 65.0)]
    assert [tuple(r) for r in serving.channel_mix(wide).collect()] == [("(pre-app)", 2), ("delivery", 2), ("in_store", 1)]
    assert [tuple(r) for r in serving.top_stores(wide, 1).collect()] == [("S1", "Hanoi", 436.0)]
    assert [r.customer_id for r in serving.top_customers_as_of(feats, "2025-09-01").collect()] == ["C1"]
    assert serving.top_customers_as_of(feats, "2025-01-01").count() == 0


def test_feature_views(built, spark, rows):
    export = export_features(built["feat_customer_90d"], ["customer_id"])
    late, early = dt.datetime(2025, 9, 1), dt.datetime(2025, 1, 1)
    labels = spark.createDataFrame([("C1", late), ("C1", early)], "customer_id string, label_time timestamp_ntz")
    got = historical_features(labels, export, CUSTOMER_90D, "label_time")
    assert rows(got, "customer_id", "label_time", "f_total_orders_90d") == [("C1", late, 2)]
    online = materialize(export, CUSTOMER_90D, "2025-01-01", "2026-01-01")
    asked = spark.createDataFrame([("C1",), ("nobody",)], "customer_id string")
    assert rows(online_lookup(online, asked, CUSTOMER_90D), "customer_id", "f_total_orders_90d") == [("C1", 2), ("nobody", None)]
    assert materialize(export, CUSTOMER_90D, "2026-01-01", "2027-01-01").count() == 0
    assert rows(refresh_online(online, online, CUSTOMER_90D)) == rows(online)


def test_a_view_checks_its_columns(spark):
    view = FeatureView("v", ("k",), created=None, fields={"f": "bigint", "g": "double"})
    df = spark.createDataFrame([("a", dt.datetime(2025, 1, 1), 1)], "k string, event_timestamp timestamp_ntz, f int")
    with pytest.raises(ValueError, match="lacks g"):
        view.select(df)
    assert dict(FeatureView("v", ("k",), created=None, fields={"f": "bigint"}).select(df).dtypes)["f"] == "bigint"


def test_payments(spark, rows):
    raw = retail.tables(spark)
    # The amount due still counts the copied line: payments are raised before the copies go.
    assert rows(payment_base(raw["orders"], raw["order_items"]), "order_id", "amount", "payment_status") == [
        ("O1", 353.8, "success"), ("O2", 180.0, "success"), ("O3", 65.0, "success"), ("O4", 0.0, "failed"), ("O5", 10.0, "success"),
    ]
    df = raw["payments"].drop("payment_id")
    assert rows(numbered(df, ["payment_timestamp", "order_id", "payment_method"], "id", "PAY", 3), "id", "payment_method") == [
        ("PAY001", "card"), ("PAY002", "cash"), ("PAY003", "cash"),
    ]
