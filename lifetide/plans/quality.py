"""Data-quality plans: key checks on the data itself (V3, V4)."""

from __future__ import annotations

from lifetide.operators import quality as Q
from lifetide.plans.catalog import query
from lifetide.sources.bridge import Bridge


@query("pk_violations")
def pk_violations(spark, base):
    b = Bridge(spark, base)
    items = b.order_items(with_part=False)
    return Q.pk_violations({
        "customers": (b.customers(), ["store_id", "customer_id"]),
        "orders": (b.orders(), ["store_id", "order_id"]),
        "order_items": (items, ["order_item_id"]),
        "order_lines": (items, ["order_id", "line_number"]),
        "abandoned_checkouts": (b.abandoned_checkouts(), ["store_id", "checkout_id"]),
        "refunds": (b.refunds(), ["refund_id"]),
    })


@query("fk_orphans")
def fk_orphans(spark, base):
    b = Bridge(spark, base)
    customers, orders = b.customers(), b.orders()
    return Q.fk_orphans({
        "orders.customer_id": (orders, customers, ["store_id", "customer_id"]),
        "order_items.order_id": (b.order_items(with_part=False), orders, ["order_id"]),
        "abandoned_checkouts.customer_id": (b.abandoned_checkouts(), customers,
                                            ["store_id", "customer_id"]),
        "refunds.order_id": (b.refunds(), orders, ["order_id"]),
    })

