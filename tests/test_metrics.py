"""CLV metrics on a hand fixture: fan-out, guests, status, reports."""

import datetime as dt
from decimal import Decimal

import pytest

from lifetide.operators import metrics as M
from lifetide.operators import reports as R

AS_OF = "2024-06-01 00:00:00"
D0 = dt.datetime(2024, 5, 1)


@pytest.fixture()
def model(spark):
    customers = spark.createDataFrame(
        [("s1", "c1", "c1@x", "A", "One", "enabled", "new"),
         ("s1", "c2", "c2@x", "B", "Two", "enabled", "new")],
        "store_id string, customer_id string, email string, first_name string, last_name string, "
        "customer_state string, status string")
    orders = spark.createDataFrame(
        [("s1", "o1", "c1", Decimal("100.00"), D0), ("s1", "o2", "c1", Decimal("50.00"), D0 + dt.timedelta(1)),
         ("s1", "o3", None, Decimal("7.00"), D0)],
        "store_id string, order_id string, customer_id string, total_price decimal(18,2), "
        "created_at timestamp_ntz")
    items = spark.createDataFrame(
        [("i1", "o1", "p1", 1, Decimal("10.00")), ("i2", "o1", "p2", 2, Decimal("20.00")),
         ("i3", "o2", "p1", 1, Decimal("10.00")), ("i4", "o2", "p1", 3, Decimal("10.00"))],
        "order_item_id string, order_id string, product_id string, quantity int, price decimal(18,2)")
    checkouts = spark.createDataFrame(
        [("s1", f"k{i}", "c1", Decimal("1.00"), D0, D0) for i in range(3)]
        + [("s1", "kg", None, Decimal("9.00"), D0, D0)],
        "store_id string, checkout_id string, customer_id string, total_price decimal(18,2), "
        "created_at timestamp_ntz, abandoned_at timestamp_ntz")
    refunds = spark.createDataFrame([("r1", "o1", Decimal("15.00"), D0)],
                                    "refund_id string, order_id string, amount decimal(18,2), created_at timestamp_ntz")
    return customers, orders, items, checkouts, refunds


def test_profile_corrected_vs_literal(spark, model):
    customers, orders, _, checkouts, refunds = model
    fixed = {r.customer_id: r for r in M.clv_profile(customers, orders, checkouts, refunds).collect()}
    lit = {r.customer_id: r for r in M.clv_profile(customers, orders, checkouts, refunds, literal=True).collect()}
    assert fixed["c1"].total_refunded == 15.0 and lit["c1"].total_refunded == 45.0  # 3 checkouts x r
    assert fixed["c1"].abandoned_checkouts_count == 3 and fixed["c1"].refunds_count == 1
    assert fixed["c1"].total_orders == 2 and fixed["c1"].total_spent == 150.0
    assert fixed["c1"].average_order_value == 75.0
    assert fixed["c2"].total_orders == 0 and fixed["c2"].average_order_value == 0.0
    assert fixed["c2"].first_order_date is None and lit["c2"].total_refunded == 0.0


def test_summary_corrected_vs_literal(spark, model):
    customers, orders, items, _, _ = model
    fixed = {r.customer_id: r for r in R.customer_summary(customers, orders, items).collect()}
    lit = {r.customer_id: r for r in R.customer_summary(customers, orders, items, literal=True).collect()}
    assert fixed["c1"].total_spent == 150.0 and lit["c1"].total_spent == 300.0  # 2 lines each
    assert fixed["c1"].order_count == 2 and fixed["c1"].total_items == 4
    assert fixed["c2"].total_spent is None and fixed["c2"].order_count == 0


def test_historic_clv_sums_orders_with_customer(spark, model):
    customers, orders, *_ = model
    got = {r.customer_id: r.historic_clv for r in M.historic_clv(customers, orders).collect()}
    assert got == {"c1": 150.0, "c2": 0.0}  # the guest order o3 belongs to nobody


def test_status_rolls_orders_and_keeps_no_order_customers(spark, model):
    customers, orders, *_ = model
    got = {r.customer_id: r for r in M.customer_status(customers, orders, AS_OF).collect()}
    assert got["c1"].status == "active" and got["c1"].orders_count == 2
    assert got["c2"].status == "new" and got["c2"].historic_clv == 0.0


def test_features_and_confidence(spark, model):
    customers, orders, _, checkouts, refunds = model
    prof = M.clv_profile(customers, orders, checkouts, refunds)
    f = {r.customer_id: r for r in M.clv_features(prof, AS_OF).collect()}
    assert f["c1"].days_since_last_order == 30.0 and f["c1"].refund_rate == 0.1
    assert f["c2"].days_since_first_order == 0.0 and f["c2"].refund_rate == 0.0
    conf = {r.customer_id: r.clv_confidence_score for r in M.clv_confidence(prof, AS_OF).collect()}
    assert conf == {"c1": 0.7, "c2": 0.42}


def test_reports(spark, model):
    customers, orders, items, checkouts, _ = model
    products = spark.createDataFrame([("p1", "Tea", Decimal("10.00")), ("p2", "Mug", Decimal("20.00"))],
                                     "product_id string, title string, price decimal(18,2)")
    top = R.popular_products(items.drop("price"), products, k=1).collect()
    assert [(r.title, r.times_ordered, r.total_quantity, r.total_revenue) for r in top] == [("Tea", 3, 5, 50.0)]
    rep = R.abandoned_checkouts_report(checkouts, customers).collect()
    assert len(rep) == 3  # the guest checkout drops out of the inner join
    st = {r.store_id: r for r in R.store_status(customers, orders).collect()}
    assert st["s1"].customer_count == 2 and st["s1"].order_count == 3
    counts = {r.table_name: r["count"] for r in R.record_counts({"customers": customers, "orders": orders}).collect()}
    assert counts == {"customers": 2, "orders": 3}


def test_profile_for_one_customer(spark, model):
    customers, orders, _, checkouts, refunds = model
    rows = M.clv_profile(customers, orders, checkouts, refunds, customer=("s1", "c1")).collect()
    assert [(r.customer_id, r.total_refunded, r.abandoned_checkouts_count) for r in rows] == [("c1", 15.0, 3)]
