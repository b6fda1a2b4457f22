"""Verification reports and store status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators.joins import keys_for
from lifetide.operators.metrics import CUSTOMER_KEY


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, count (A1 + U1).  Each count prunes its
    scan to the columns its rows depend on: none for a plain table (Parquet
    row-group metadata only; measured for orders and line items), the join
    or filter keys for a derived view (customers keep the nation key of
    their left join, checkouts the event type of their filter)."""
    parts = [df.agg(F.count(F.lit(1)).alias("count"))
             .select(F.lit(name).alias("table_name"), "count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _items_per_order(items: DataFrame) -> DataFrame:
    """Distinct items and rows per order."""
    keys = [c for c in ("store_id", "order_id") if c in items.columns]
    # typed key columns where the item key is made of them; equal items are first folded into one row with its count
    per_item = items.groupBy(*keys, "order_item_id").agg(F.count(F.lit(1)).alias("n"))
    return per_item.groupBy(*keys).agg(F.count("order_item_id").alias("n_items"), F.sum("n").alias("n_rows"))


def customer_summary(customers: DataFrame, orders: DataFrame, items: DataFrame,
                     literal: bool = False) -> DataFrame:
    """Customer summary report (A12): orders, distinct items and spend per
    customer, customers without orders included, biggest spenders first.

    Items are counted per order before meeting the orders, so the join is
    one row per order.  ``literal=False`` counts each order's price once.
    ``literal=True`` gives the fan-out number, where joining items repeats an
    order's price once per joined row (at least once): the price is weighted
    by the order's row count instead of joining line rows.
    total_spent stays NULL for customers without orders (A4).
    """
    ipo = _items_per_order(items)
    okeys = keys_for(orders, ipo, "order_id")
    o = (orders.filter(F.col("customer_id").isNotNull())
         .select(*_uniq(okeys + CUSTOMER_KEY), "total_price")
         .join(ipo, okeys, "left"))
    weight = F.greatest(F.coalesce(F.col("n_rows"), F.lit(0)), F.lit(1)) if literal else F.lit(1)
    per_customer = (o.groupBy(*CUSTOMER_KEY)
                    .agg(F.count_distinct("order_id").alias("order_count"),
                         F.sum(F.coalesce(F.col("n_items"), F.lit(0))).alias("total_items"),
                         F.sum(F.col("total_price") * weight).alias("spent")))
    c = customers.select(*CUSTOMER_KEY, "email", "first_name", "last_name", "customer_state")
    return (c.join(per_customer, CUSTOMER_KEY, "left")
            .select("customer_id", "email", "first_name", "last_name", "customer_state",
                    F.coalesce(F.col("order_count"), F.lit(0)).cast("long").alias("order_count"),
                    F.coalesce(F.col("total_items"), F.lit(0)).cast("long").alias("total_items"),
                    X.money_out("spent").alias("total_spent"))
            .orderBy(F.desc_nulls_last("total_spent"), F.asc("customer_id")))


def popular_products(items: DataFrame, products: DataFrame | None = None, k: int = 5) -> DataFrame:
    """Top-k products by revenue.

    Line items are first combined per product (a partial aggregate of the
    largest table) and only then meet the product table, so the join and
    the shuffle are product-sized, not line-sized.  ``products`` supplies
    (product_id, title, price) when the items do not carry them.  The top-k
    stays a distributed TakeOrderedAndProject; title breaks revenue ties.
    """
    if products is None:
        per_product = (items.groupBy("product_id", "title", "price")
                       .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("qty")))
    else:
        per_product = (items.groupBy("product_id")
                       .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("qty"))
                       .join(products.select("product_id", "title", "price"), "product_id", "left"))
    per_title = (per_product.groupBy("title")
                 .agg(F.sum("n").alias("times_ordered"),
                      F.sum("qty").alias("total_quantity"),
                      F.sum(F.col("price") * F.col("n")).alias("price_sum"),
                      F.sum(F.when(F.col("price").isNotNull(), F.col("n"))).alias("price_n"),
                      F.sum(F.col("qty") * F.col("price")).alias("revenue")))
    return (per_title.select(
        "title",
        F.col("times_ordered").cast("long").alias("times_ordered"),
        F.col("total_quantity").cast("long").alias("total_quantity"),
        (X.money_out("price_sum") / F.col("price_n").cast("double")).alias("avg_price"),
        X.money_out("revenue").alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc("title"))
        .limit(k))


def abandoned_checkouts_report(abandoned: DataFrame, customers: DataFrame,
                               minutes_mode: str = "boundary") -> DataFrame:
    """Abandoned checkouts of known customers, largest cart first.

    Inner join: guest checkouts (NULL customer) drop out, and Spark filters
    their NULL keys before the shuffle."""
    c = customers.select(*CUSTOMER_KEY, "email", "first_name", "last_name")
    a = abandoned.select(*CUSTOMER_KEY, "checkout_id", "total_price", "created_at", "abandoned_at")
    return (a.join(c, CUSTOMER_KEY, "inner")
            .select("checkout_id", "email", "first_name", "last_name",
                    X.money_out("total_price").alias("total_price"),
                    "created_at", "abandoned_at",
                    X.minutes_between("created_at", "abandoned_at", minutes_mode)
                    .alias("minutes_to_abandon"))
            .orderBy(F.desc_nulls_last("total_price"), F.asc("checkout_id")))


def store_status(customers: DataFrame, orders: DataFrame, registry: DataFrame | None = None,
                 load_status: DataFrame | None = None) -> DataFrame:
    """Per store: customer_count, order_count, last_order_date, state (A10).

    All stores in one job: two partial aggregates by store, full-outer joined
    (a store may have customers and no orders, or the reverse).  A store of
    ``registry`` without rows is listed with zeros.  The state is 'error' when
    the last sync (``load_status``: store_id, success) failed for the store in
    any table, else 'active'."""
    cc = customers.groupBy("store_id").agg(F.count(F.lit(1)).alias("customer_count"))
    oc = orders.groupBy("store_id").agg(F.count(F.lit(1)).alias("order_count"),
                                        F.max("created_at").alias("last_order_date"))
    found = cc.join(oc, "store_id", "full_outer")
    if registry is not None:
        found = registry.select("store_id").distinct().join(found, "store_id", "full_outer")
    state = F.lit("active")
    if load_status is not None:
        failed = load_status.groupBy("store_id").agg(F.bool_or(~F.col("success")).alias("failed"))
        found = found.join(failed, "store_id", "left")
        state = F.when(F.col("failed"), F.lit("error")).otherwise(state)
    return (found
            .select("store_id",
                    F.coalesce("customer_count", F.lit(0)).cast("long").alias("customer_count"),
                    F.coalesce("order_count", F.lit(0)).cast("long").alias("order_count"),
                    "last_order_date",
                    state.alias("status")))


def order_refunds(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Refunds of every order, looked up for all orders at once."""
    k = keys_for(orders, refunds, "order_id")
    o = orders.select(*_uniq(k + CUSTOMER_KEY), F.col("total_price").alias("order_total"))
    r = refunds.select(*k, "refund_id", "amount", F.col("created_at").alias("refunded_at"))
    return (o.join(r, k, "inner")
            .select("store_id", "order_id", "customer_id", "refund_id",
                    X.money_out("order_total").alias("order_total"),
                    X.money_out("amount").alias("amount"), "refunded_at"))


def _uniq(cols: list[str]) -> list[str]:
    return list(dict.fromkeys(cols))
