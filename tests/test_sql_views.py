"""SQL over the registered model views equals the DataFrame reports, and hand rows give the worked answers."""

import datetime as dt
from decimal import Decimal

from lifetide.operators import reports as R
from lifetide.sources.bridge import Bridge, register_views

from conftest import SF_SMALL


def test_views_hold_the_model(spark):
    """Every view has the rows of its table; a per-store roll-up in SQL agrees with the store report."""
    register_views(spark, SF_SMALL)
    b = Bridge(spark, SF_SMALL)
    tables = {"customers": b.customers(), "orders": b.orders(), "order_items": b.order_items(with_part=False),
              "abandoned_checkouts": b.abandoned_checkouts()}
    counted = {r["table_name"]: r["count"] for r in R.record_counts(tables).collect()}
    assert counted == {name: spark.table(name).count() for name in tables}
    by_store = spark.sql("""
        WITH per_store AS (SELECT store_id, count(*) AS n, max(created_at) AS newest FROM orders GROUP BY store_id)
        SELECT store_id, n, newest FROM per_store""")
    report = R.store_status(b.customers(), b.orders()).select("store_id", "order_count", "last_order_date")
    assert sorted(map(tuple, by_store.collect())) == sorted(map(tuple, report.collect()))


def hand_model(spark):
    """Two stores that share the customer id 1; order 10 has two rows of one item and one of another, order 11 none."""
    customers = spark.createDataFrame(
        [("s1", "1", "a@x", "A", "AA", "enabled"), ("s2", "1", "b@x", "B", "BB", "enabled"), ("s1", "2", "c@x", "C", "CC", "disabled")],
        "store_id string, customer_id string, email string, first_name string, last_name string, customer_state string")
    orders = spark.createDataFrame(
        [("s1", "10", "1", Decimal("10.00")), ("s1", "11", "1", Decimal("5.00")), ("s2", "10", "1", Decimal("7.00")), ("s1", "12", None, Decimal("9.00"))],
        "store_id string, order_id string, customer_id string, total_price decimal(18,2)")
    items = spark.createDataFrame(
        [("s1", "10", "i1"), ("s1", "10", "i1"), ("s1", "10", "i2")], "store_id string, order_id string, order_item_id string")
    return customers, orders, items


def test_summary_worked_answers(spark):
    """Joined rows weigh the literal form (3 x 10 + 5), distinct items are counted (2), stores do not mix."""
    got = {(r["email"]): (r["order_count"], r["total_items"], r["total_spent"])
           for r in R.customer_summary(*hand_model(spark), literal=True).collect()}
    assert got == {"a@x": (2, 2, 35.0), "b@x": (1, 0, 7.0), "c@x": (0, 0, None)}
    got = {(r["email"]): (r["order_count"], r["total_items"], r["total_spent"]) for r in R.customer_summary(*hand_model(spark)).collect()}
    assert got == {"a@x": (2, 2, 15.0), "b@x": (1, 0, 7.0), "c@x": (0, 0, None)}


def test_checkout_report_worked_answers(spark):
    customers, _, _ = hand_model(spark)
    t = lambda m, s: dt.datetime(2024, 1, 1, 0, m, s)
    carts = spark.createDataFrame(
        [("s1", "k1", "1", Decimal("3.00"), t(0, 59), t(1, 1)), ("s2", "k2", "1", Decimal("8.00"), t(0, 0), t(9, 59)), ("s1", "k3", None, Decimal("99.00"), t(0, 0), t(1, 0)),
         ("s3", "k4", "1", Decimal("1.00"), t(0, 0), t(1, 0))],
        "store_id string, checkout_id string, customer_id string, total_price decimal(18,2), created_at timestamp_ntz, abandoned_at timestamp_ntz")
    got = [(r["checkout_id"], r["email"], r["minutes_to_abandon"]) for r in R.abandoned_checkouts_report(carts, customers).collect()]
    assert got == [("k2", "b@x", 9), ("k1", "a@x", 1)]
