"""Hand fixtures for the flatten operators."""

import datetime as dt
import json
from decimal import Decimal

from lifetide.operators import flatten as P
from lifetide.schemas import CUSTOMERS


def feed(spark, *payloads, store="store_x"):
    return spark.createDataFrame([(store, json.dumps(p)) for p in payloads], "store_id string, payload string")


def test_customer_without_address_and_consent(spark):
    rows = P.flatten_customers(feed(spark, {"id": 5, "email": "a@b", "state": "disabled"},
                                    {"id": 6, "default_address": {"country": "NL", "city": "Delft"},
                                     "email_marketing_consent": {"state": "subscribed"},
                                     "total_spent": "12.50", "tags": "vip"})).orderBy("customer_id").collect()
    a, b = rows
    assert (a.country, a.city, a.zip, a.accepts_marketing) == (None, None, None, False)
    assert a.customer_state == "disabled" and a.orders_count == 0 and a.currency == "USD"
    assert a.total_spent == Decimal("0.00") and a.tags == "[]" and a.store_id == "store_x"
    assert (b.country, b.city, b.accepts_marketing, b.total_spent, b.tags) == \
        ("NL", "Delft", True, Decimal("12.50"), '"vip"')
    assert b.customer_state == "enabled" and b.verified_email is False


def test_customer_without_defaults_keeps_nulls(spark):
    r = P.flatten_customers(feed(spark, {"id": 7}), defaults=False).first()
    assert r.orders_count is None and r.total_spent is None and r.customer_state is None


def test_order_guest_and_item_lists(spark):
    f = feed(spark,
             {"id": 1, "name": "#1", "created_at": "2024-01-15T10:00:00-05:00", "line_items": []},
             {"id": 2, "order_number": 1002, "customer": {"id": 9}, "total_price": "",
              "created_at": "2024-01-15T10:00:00Z",
              "line_items": [{"id": 21, "product_id": 0, "quantity": 2, "price": "3.50"},
                             {"id": 22, "variant_id": 4, "taxable": False}]},
             {"id": 3, "customer": {"id": 0}})
    o = {r.order_id: r for r in P.flatten_orders(f).collect()}
    assert o["1"].customer_id is None and o["1"].order_number == "#1" and o["1"].total_items == 0
    assert o["1"].created_at == dt.datetime(2024, 1, 15, 15, 0)
    assert o["2"].customer_id == "9" and o["2"].order_number == "1002" and o["2"].total_items == 2
    assert o["2"].total_price == Decimal("0.00")
    assert o["3"].customer_id is None and o["3"].total_items == 0  # id 0 is falsy -> NULL
    items = {r.order_item_id: r for r in P.explode_line_items(f).collect()}
    assert set(items) == {"21", "22"}  # inner explode: orders 1 and 3 yield nothing
    assert items["21"].product_id is None and items["21"].price == Decimal("3.50")
    assert items["21"].created_at == dt.datetime(2024, 1, 15, 10, 0) and items["21"].taxable is True
    assert items["22"].variant_id == "4" and items["22"].quantity == 0 and items["22"].taxable is False


def test_item_rows_ignore_bad_values_in_other_order_fields(spark):
    # items parse only the order fields they read; a wrongly typed value in
    # another field must not change them (nor would it under the full parse)
    line = {"id": 11, "product_id": 3, "price": "2.50", "quantity": 2}
    good = {"id": 1, "created_at": "2024-01-01T10:00:00Z", "test": False, "line_items": [line]}
    bad = {**good, "id": 2, "test": "yes", "total_weight": {"oops": 1}}
    items = P.explode_line_items(feed(spark, good, bad)).orderBy("order_id").collect()
    assert [(r.order_id, r.order_item_id, r.product_id, r.price, r.quantity) for r in items] == \
        [("1", "11", "3", Decimal("2.50"), 2), ("2", "11", "3", Decimal("2.50"), 2)]
    assert items[0].created_at == items[1].created_at == dt.datetime(2024, 1, 1, 10, 0)
    full = P.explode_line_items(P.parse(feed(spark, bad), P.ORDER_PAYLOAD)).collect()
    assert [(r.order_id, r.price) for r in full] == [("2", Decimal("2.50"))]


def test_checkouts_abandoned_at_and_filter(spark):
    f = feed(spark, {"id": 1, "created_at": "2024-01-01T00:00:00Z", "completed_at": "2024-01-01T01:00:00Z",
                     "customer": {"id": 3}},
             {"id": 2, "created_at": "2024-01-02T00:00:00Z"})
    c = P.flatten_checkouts(f)
    rows = {r.checkout_id: r for r in c.collect()}
    assert rows["2"].abandoned_at == rows["2"].created_at and rows["2"].customer_id is None
    assert [r.checkout_id for r in P.abandoned_only(c).collect()] == ["2"]


def test_align_and_text_columns(spark):
    df = spark.createDataFrame([("s", "1", "x", dt.datetime(2024, 1, 1))],
                               "STORE_ID string, Customer_ID string, unknown string, created_at timestamp_ntz")
    aligned = P.align_to(df, CUSTOMERS)
    assert aligned.columns == ["store_id", "customer_id", "created_at"]
    assert P.as_text_columns(aligned).first().created_at == "2024-01-01 00:00:00"
