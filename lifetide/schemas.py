"""Canonical table schemas, keys and payload schemas.

Money is DECIMAL(18,2) while stored and summed (exact, and identical in any
engine); reports cast it to DOUBLE once, at the end.  Timestamps are
TIMESTAMP_NTZ holding the UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()
S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DoubleType()
B = T.BooleanType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The key of every table is (store_id, <id column>).  Written out
# explicitly, never derived from the table name.
KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "abandoned_checkouts": "checkout_id",
    "refunds": "refund_id",
    "customer_metrics": "customer_id",
    "customer_rollups": "customer_id",
}

# Customer status domain.
STATUS_ACTIVE, STATUS_INACTIVE, STATUS_NEW = "active", "inactive", "new"

CUSTOMERS = _schema(
    ("store_id", S), ("customer_id", S), ("email", S), ("first_name", S), ("last_name", S),
    ("orders_count", I), ("total_spent", MONEY), ("status", S), ("first_order_date", TS),
    ("last_order_date", TS), ("clv_prediction", MONEY), ("accepts_marketing", B),
    ("customer_state", S), ("last_order_id", S), ("note", S), ("verified_email", B),
    ("tax_exempt", B), ("tags", S), ("currency", S), ("country", S), ("province", S),
    ("city", S), ("zip", S), ("customer_locale", S), ("created_at", TS), ("updated_at", TS),
    ("ingestion_timestamp", TS),
)

ORDERS = _schema(
    ("store_id", S), ("order_id", S), ("customer_id", S), ("order_number", S),
    ("order_status", S), ("total_price", MONEY), ("subtotal_price", MONEY), ("total_tax", MONEY),
    ("total_discounts", MONEY), ("currency", S), ("financial_status", S),
    ("fulfillment_status", S), ("processing_method", S), ("source_name", S), ("gateway", S),
    ("test", B), ("taxes_included", B), ("total_weight", D), ("total_items", I), ("tags", S),
    ("shipping_name", S), ("shipping_address1", S), ("shipping_city", S),
    ("shipping_province", S), ("shipping_country", S), ("shipping_zip", S),
    ("order_date", TS), ("created_at", TS), ("updated_at", TS), ("cancelled_at", TS),
    ("closed_at", TS), ("processed_at", TS), ("cancel_reason", S), ("ingestion_timestamp", TS),
)

ORDER_ITEMS = _schema(
    ("store_id", S), ("order_item_id", S), ("order_id", S), ("product_id", S), ("variant_id", S),
    ("title", S), ("name", S), ("sku", S), ("vendor", S), ("quantity", I), ("price", MONEY),
    ("total_discount", MONEY), ("requires_shipping", B), ("taxable", B), ("gift_card", B),
    ("fulfillable_quantity", I), ("fulfillment_status", S), ("grams", I), ("created_at", TS),
    ("updated_at", TS), ("ingestion_timestamp", TS),
)

ABANDONED_CHECKOUTS = _schema(
    ("store_id", S), ("checkout_id", S), ("customer_id", S), ("email", S), ("total_price", MONEY),
    ("subtotal_price", MONEY), ("total_tax", MONEY), ("total_discounts", MONEY), ("currency", S),
    ("completed_at", TS), ("created_at", TS), ("updated_at", TS), ("abandoned_at", TS),
    ("recovery_url", S), ("ingestion_timestamp", TS),
)

REFUNDS = _schema(
    ("store_id", S), ("refund_id", S), ("order_id", S), ("customer_id", S), ("status", S),
    ("amount", MONEY), ("currency", S), ("reason", S), ("note", S), ("restock_items", B),
    ("created_at", TS), ("processed_at", TS), ("ingestion_timestamp", TS),
)

CUSTOMER_METRICS = _schema(
    ("store_id", S), ("customer_id", S), ("total_orders", L), ("total_spent", D),
    ("average_order_value", D), ("first_order_date", TS), ("last_order_date", TS),
    ("abandoned_checkouts_count", L), ("refunds_count", L), ("total_refunded", D),
    ("refund_rate", D), ("predicted_clv", D), ("clv_confidence_score", D),
    ("last_prediction_date", TS), ("updated_at", TS),
)

TABLES = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "abandoned_checkouts": ABANDONED_CHECKOUTS,
    "refunds": REFUNDS,
    "customer_metrics": CUSTOMER_METRICS,
}

# What the stored orders, checkouts and refunds of a customer add up to.  Kept by
# differences (operators/rollups.py); customers and customer_metrics are derived from it.
CUSTOMER_ROLLUPS = _schema(
    ("store_id", S), ("customer_id", S), ("n_orders", L), ("spent", MONEY), ("first_order_date", TS),
    ("last_order_date", TS), ("checkouts", L), ("refunds", L), ("refunded", MONEY), ("updated_at", TS),
)
#: tables of the model, and the tables that keep its state
STORED = {**TABLES, "customer_rollups": CUSTOMER_ROLLUPS}

# ---------------------------------------------------------------------------
# Nested payload schemas (input of the flatten operators).  Amounts and times
# are text, ids are numbers, exactly as the shop API delivers them.
# ---------------------------------------------------------------------------
ADDRESS = _schema(("country", S), ("province", S), ("city", S), ("zip", S))
SHIPPING = _schema(("name", S), ("address1", S), ("city", S), ("province", S),
                   ("country", S), ("zip", S))
REF = _schema(("id", L))

CUSTOMER_PAYLOAD = _schema(
    ("id", L), ("email", S), ("first_name", S), ("last_name", S), ("orders_count", I),
    ("total_spent", S), ("created_at", S), ("updated_at", S), ("accepts_marketing", B),
    ("state", S), ("last_order_id", L), ("note", S), ("verified_email", B), ("tax_exempt", B),
    ("tags", S), ("currency", S), ("email_marketing_consent", _schema(("state", S))),
    ("default_address", ADDRESS),
)

LINE_ITEM_PAYLOAD = _schema(
    ("id", L), ("product_id", L), ("variant_id", L), ("title", S), ("name", S),
    ("quantity", I), ("price", S), ("sku", S), ("vendor", S), ("requires_shipping", B),
    ("taxable", B), ("gift_card", B), ("fulfillable_quantity", I), ("fulfillment_status", S),
    ("grams", I), ("total_discount", S),
)

ORDER_PAYLOAD = _schema(
    ("id", L), ("name", S), ("order_number", L), ("customer", REF), ("total_price", S),
    ("subtotal_price", S), ("total_tax", S), ("total_discounts", S), ("currency", S),
    ("financial_status", S), ("fulfillment_status", S), ("processing_method", S),
    ("source_name", S), ("created_at", S), ("updated_at", S), ("cancelled_at", S),
    ("closed_at", S), ("processed_at", S), ("cancel_reason", S), ("gateway", S), ("test", B),
    ("taxes_included", B), ("total_weight", D), ("tags", S), ("shipping_address", SHIPPING),
    ("line_items", T.ArrayType(LINE_ITEM_PAYLOAD)),
    # an order with very many items comes in several payloads: the first
    # (no line_page, or 0) heads the order, the others only carry more items
    ("line_items_count", L), ("line_page", I),
)

CHECKOUT_PAYLOAD = _schema(
    ("id", L), ("customer", REF), ("email", S), ("total_price", S), ("subtotal_price", S),
    ("total_tax", S), ("total_discounts", S), ("currency", S), ("completed_at", S),
    ("created_at", S), ("updated_at", S), ("recovery_url", S),
)

REFUND_PAYLOAD = _schema(
    ("id", L), ("order_id", L), ("customer", REF), ("status", S), ("amount", S), ("currency", S), ("reason", S),
    ("note", S), ("restock", B), ("created_at", S), ("processed_at", S),
)

# A change event carries a customer part, an order part, or both, and the
# store it came from.
CHANGE_EVENT = _schema(("store_id", S), ("customer", CUSTOMER_PAYLOAD), ("order", ORDER_PAYLOAD))
# the column that keeps the text of an event line that cannot be read
CORRUPT = "_corrupt"

# Rows set aside (K9): which resource, where they came from, what was wrong, the record as text.
QUARANTINE = _schema(("resource", S), ("store_id", S), ("page", S), ("problem", S), ("payload", S), ("quarantined_at", TS))

# What a sync did per store and table (K9, A10).
LOAD_STATUS = _schema(("store_id", S), ("table_name", S), ("rows_loaded", L), ("rows_quarantined", L), ("success", B), ("error", S),
                      ("synced_at", TS))

# Landed pages that could not be read, to be tried again by the next sync (K9).
HELD_PAGES = _schema(("store_id", S), ("page", S), ("error", S), ("since", TS))


def empty(spark, name: str):
    """An empty DataFrame with the canonical schema of ``name``."""
    return spark.createDataFrame([], TABLES[name])
