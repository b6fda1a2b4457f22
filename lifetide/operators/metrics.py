"""Customer metrics: order roll-up, historic CLV, status, CLV profile, features.

Shape of every job: aggregate each one-to-many branch per key first (partial
aggregation combines a hot customer map-side, so no task ever holds one
customer's raw rows), then join one row per customer on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators.joins import keys_for
from lifetide.schemas import MONEY

CUSTOMER_KEY = ["store_id", "customer_id"]


def order_rollup(orders: DataFrame) -> DataFrame:
    """Per customer: number of orders, exact spend, first and last order.

    Orders without a customer (guest orders) have no customer to roll onto."""
    return (orders.filter(F.col("customer_id").isNotNull())
            .groupBy(*CUSTOMER_KEY)
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum("total_price").alias("spent"),
                 F.min("created_at").alias("first_order_date"),
                 F.max("created_at").alias("last_order_date")))


def customer_metrics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """total_orders, total_spent, average_order_value (0 without orders),
    first/last order date (NULL without orders) for every customer (A7, X5)."""
    r = order_rollup(orders)
    c = customers.select(*CUSTOMER_KEY)
    return (c.join(r, CUSTOMER_KEY, "left")
            .select(*CUSTOMER_KEY,
                    F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("total_orders"),
                    X.money_out(F.coalesce(F.col("spent"), F.lit(0).cast(MONEY))).alias("total_spent"),
                    X.guarded_ratio(F.coalesce(F.col("spent"), F.lit(0).cast(MONEY)),
                                    F.coalesce(F.col("n_orders"), F.lit(0))).alias("average_order_value"),
                    "first_order_date", "last_order_date"))


def historic_clv(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Sum of order totals per customer, 0.0 without orders."""
    r = order_rollup(orders)
    return (customers.select(*CUSTOMER_KEY).join(r, CUSTOMER_KEY, "left")
            .select(*CUSTOMER_KEY,
                    X.money_out(F.coalesce(F.col("spent"), F.lit(0).cast(MONEY))).alias("historic_clv")))


def customer_status(customers: DataFrame, orders: DataFrame, as_of) -> DataFrame:
    """Roll order history onto customers and set status.

    Customers with orders get counts, spend, first/last dates and
    active/inactive by a 90-day recency; customers without orders keep their
    stored values (status 'new' when none is stored).  Historic CLV is kept
    in its own column, never in the prediction column."""
    r = order_rollup(orders)
    has = F.col("n_orders").isNotNull()
    stored_status = F.col("status") if "status" in customers.columns else F.lit(None).cast("string")
    stored_count = F.col("orders_count") if "orders_count" in customers.columns else F.lit(0)
    stored_spent = F.col("total_spent") if "total_spent" in customers.columns else F.lit(0).cast(MONEY)
    c = customers.select(*CUSTOMER_KEY, stored_status.alias("status0"),
                         stored_count.cast("long").alias("count0"),
                         stored_spent.cast(MONEY).alias("spent0"))
    return (c.join(r, CUSTOMER_KEY, "left")
            .select(*CUSTOMER_KEY,
                    F.when(has, F.col("n_orders")).otherwise(F.col("count0")).cast("long").alias("orders_count"),
                    X.money_out(F.when(has, F.col("spent")).otherwise(F.col("spent0"))).alias("total_spent"),
                    "first_order_date", "last_order_date",
                    X.status("last_order_date", as_of, F.col("status0")).alias("status"),
                    X.money_out(F.coalesce(F.col("spent"), F.lit(0).cast(MONEY))).alias("historic_clv")))


def checkout_rollup(abandoned: DataFrame) -> DataFrame:
    """Abandoned checkouts per customer (distinct ids); guests excluded."""
    return (abandoned.filter(F.col("customer_id").isNotNull())
            .groupBy(*CUSTOMER_KEY)
            .agg(F.count_distinct("checkout_id").alias("abandoned_checkouts_count"),
                 F.count(F.lit(1)).alias("checkout_rows")))


def refund_rollup(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Refund count and exact refunded amount per customer, reached through
    the refunded order (J2-J3).  Refunds are first combined per order, so the
    join with orders is one-to-one."""
    per_order = (refunds.groupBy(*(keys_for(refunds, orders, "order_id")))
                 .agg(F.count_distinct("refund_id").alias("n_refunds"),
                      F.sum("amount").alias("refunded")))
    o = orders.select(*(keys_for(refunds, orders, "order_id")), *[
        c for c in CUSTOMER_KEY if c not in keys_for(refunds, orders, "order_id")])
    return (per_order.join(o, keys_for(refunds, orders, "order_id"), "inner")
            .filter(F.col("customer_id").isNotNull())
            .groupBy(*CUSTOMER_KEY)
            .agg(F.sum("n_refunds").alias("refunds_count"),
                 F.sum("refunded").alias("refunded")))


def refunds_by_customer(customers: DataFrame, refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """refunds_count and COALESCE(SUM(amount), 0) per customer (A3)."""
    rr = refund_rollup(refunds, orders)
    return (customers.select(*CUSTOMER_KEY).join(rr, CUSTOMER_KEY, "left")
            .select(*CUSTOMER_KEY,
                    F.coalesce(F.col("refunds_count"), F.lit(0)).cast("long").alias("refunds_count"),
                    X.money_out(F.coalesce(F.col("refunded"), F.lit(0).cast(MONEY))).alias("total_refunded")))


def clv_profile(customers: DataFrame, orders: DataFrame, abandoned: DataFrame,
                refunds: DataFrame, literal: bool = False,
                customer: tuple[str, str] | None = None) -> DataFrame:
    """CLV profile per customer (A11): metrics + abandoned checkouts +
    refund count + total refunded.

    ``literal=False`` (default) aggregates each branch on its own.
    ``literal=True`` gives the fan-out form, where joining checkouts and refunds side by side multiplies every refund amount by the
    customer's number of checkout rows (at least 1).  That value is computed
    from the two per-customer aggregates -- exactly the same number, without
    materialising the cross product of a customer's checkouts and refunds.
    ``customer=(store_id, customer_id)`` restricts the job to one customer
    (the reference's bound parameter); the default runs for everyone.
    """
    if customer is not None:
        # one customer; the predicate reaches every scan before any
        # aggregate (refunds follow through the filtered orders)
        store, cid = customer
        one = (F.col("store_id") == store) & (F.col("customer_id") == cid)
        customers, orders, abandoned = customers.filter(one), orders.filter(one), abandoned.filter(one)
    m = customer_metrics(customers, orders)
    ck = checkout_rollup(abandoned)
    rr = refund_rollup(refunds, orders)
    out = m.join(ck, CUSTOMER_KEY, "left").join(rr, CUSTOMER_KEY, "left")
    refunded = F.coalesce(F.col("refunded"), F.lit(0).cast(MONEY))
    if literal:
        refunded = refunded * F.greatest(F.coalesce(F.col("checkout_rows"), F.lit(0)), F.lit(1))
    return out.select(
        *CUSTOMER_KEY, "total_orders", "total_spent", "average_order_value",
        "first_order_date", "last_order_date",
        F.coalesce(F.col("abandoned_checkouts_count"), F.lit(0)).cast("long").alias("abandoned_checkouts_count"),
        F.coalesce(F.col("refunds_count"), F.lit(0)).cast("long").alias("refunds_count"),
        X.money_out(refunded).alias("total_refunded"))


def clv_features(profile: DataFrame, as_of, keep: tuple[str, ...] = ()) -> DataFrame:
    """The model's seven features, in fixed order (M1); ``keep``: columns to carry along.

    Days since first/last order are whole 24-hour periods (0 when missing);
    refund_rate is total_refunded / total_spent, 0 when nothing was spent."""
    return profile.select(
        *CUSTOMER_KEY,
        F.col("total_orders").cast("double").alias("total_orders"),
        F.col("average_order_value").cast("double").alias("average_order_value"),
        X.whole_days_or_zero("first_order_date", as_of).cast("double").alias("days_since_first_order"),
        X.whole_days_or_zero("last_order_date", as_of).cast("double").alias("days_since_last_order"),
        F.col("abandoned_checkouts_count").cast("double").alias("abandoned_checkouts_count"),
        F.col("refunds_count").cast("double").alias("refunds_count"),
        X.guarded_ratio("total_refunded", "total_spent").alias("refund_rate"),
        *keep,
    )


FEATURES = ["total_orders", "average_order_value", "days_since_first_order",
            "days_since_last_order", "abandoned_checkouts_count", "refunds_count", "refund_rate"]


def clv_confidence(metrics: DataFrame, as_of) -> DataFrame:
    """Confidence score per customer."""
    return metrics.select(*CUSTOMER_KEY, "total_orders", "first_order_date", "last_order_date",
                          X.confidence("total_orders", "first_order_date", "last_order_date",
                                       as_of).alias("clv_confidence_score"))


def recency_days(metrics: DataFrame, as_of) -> DataFrame:
    """Whole days since first and last order; NULL when there is no order."""
    return metrics.select(*CUSTOMER_KEY,
                          X.whole_days("first_order_date", as_of).alias("days_since_first_order"),
                          X.whole_days("last_order_date", as_of).alias("days_since_last_order"))


def refund_rate(profile: DataFrame) -> DataFrame:
    """Guarded refund rate per customer."""
    return profile.select(*CUSTOMER_KEY, "total_spent", "total_refunded",
                          X.guarded_ratio("total_refunded", "total_spent").alias("refund_rate"))
