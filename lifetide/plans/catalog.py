"""Named queries over whole tables: ``(spark, base_dir) -> DataFrame``.

``lifetide.plans.oracle`` (unless it cannot be written in SQL).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators import metrics as M
from lifetide.operators import reports as R
from lifetide.sources.bridge import AS_OF, ORDER_SNAPSHOT_BEFORE, Bridge

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _b(spark, base) -> Bridge:
    return Bridge(spark, base)


# ------------------------------------------------------------------ metrics
@query("historic_clv")
def historic_clv(spark, base):
    b = _b(spark, base)
    return M.historic_clv(b.customers(), b.orders())


@query("customer_metrics")
def customer_metrics(spark, base):
    b = _b(spark, base)
    return M.customer_metrics(b.customers(), b.orders())


@query("customer_status")
def customer_status(spark, base):
    b = _b(spark, base)
    return M.customer_status(b.customers(), b.orders(), AS_OF)


@query("refunds_by_customer")
def refunds_by_customer(spark, base):
    b = _b(spark, base)
    return M.refunds_by_customer(b.customers(), b.refunds(), b.orders())


def _profile(spark, base, literal=False):
    b = _b(spark, base)
    return M.clv_profile(b.customers(), b.orders(), b.abandoned_checkouts(), b.refunds(), literal=literal)


@query("clv_profile")
def clv_profile(spark, base):
    return _profile(spark, base)


@query("clv_profile_literal")
def clv_profile_literal(spark, base):
    return _profile(spark, base, literal=True)


@query("clv_features")
def clv_features(spark, base):
    return M.clv_features(_profile(spark, base), AS_OF)


@query("clv_confidence")
def clv_confidence(spark, base):
    return M.clv_confidence(customer_metrics(spark, base), AS_OF)


@query("recency_days")
def recency_days(spark, base):
    return M.recency_days(customer_metrics(spark, base), AS_OF)


@query("refund_rate")
def refund_rate(spark, base):
    return M.refund_rate(_profile(spark, base))


# ------------------------------------------------------------------ reports
@query("record_counts")
def record_counts(spark, base):
    b = _b(spark, base)
    return R.record_counts({"customers": b.customers(), "orders": b.orders(),
                            "order_items": b.order_items(with_part=False),
                            "abandoned_checkouts": b.abandoned_checkouts()})


@query("customer_summary")
def customer_summary(spark, base):
    b = _b(spark, base)
    return R.customer_summary(b.customers(), b.orders(), b.order_items(with_part=False))


@query("customer_summary_literal")
def customer_summary_literal(spark, base):
    b = _b(spark, base)
    return R.customer_summary(b.customers(), b.orders(), b.order_items(with_part=False), literal=True)


@query("popular_products")
def popular_products(spark, base):
    b = _b(spark, base)
    return R.popular_products(b.order_items(with_part=False), b.products())


@query("abandoned_checkouts_report")
def abandoned_checkouts_report(spark, base):
    b = _b(spark, base)
    return R.abandoned_checkouts_report(b.abandoned_checkouts(), b.customers())


@query("minutes_to_abandon")
def minutes_to_abandon(spark, base):
    a = _b(spark, base).abandoned_checkouts()
    return a.select("checkout_id", "created_at", "abandoned_at",
                    X.minutes_between("created_at", "abandoned_at", "boundary").alias("minutes_boundary"),
                    X.minutes_between("created_at", "abandoned_at", "elapsed").alias("minutes_elapsed"))


@query("order_refunds")
def order_refunds(spark, base):
    b = _b(spark, base)
    return R.order_refunds(b.orders(), b.refunds())


# ------------------------------------------------------------------ filters
@query("abandoned_only")
def abandoned_only(spark, base):
    a = _b(spark, base).abandoned_checkouts()
    return a.select("store_id", "checkout_id", "customer_id",
                    X.money_out("total_price").alias("total_price"), "created_at")


@query("status_any")
def status_any(spark, base):
    """Every order counts, whatever its status (F3): no status filter."""
    o = _b(spark, base).orders()
    return (o.groupBy("financial_status")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 X.money_out(F.sum("total_price")).alias("total_price")))


@query("lookback_orders")
def lookback_orders(spark, base):
    """Lookback window plus cursor (F2, S3): the orders created within 30
    days before as_of, each flagged whether its id is above its store's mark
    from the previous sync (the rows a cursor-plus-lookback read returns)."""
    from lifetide.sources import incremental as I
    o = _b(spark, base).orders()
    marks = I.marks_of(o.filter(F.col("created_at") < X.ts_lit(ORDER_SNAPSHOT_BEFORE)), "order_id")
    return (I.flag_new(I.within_lookback(o, AS_OF), "order_id", marks)
            .select("store_id", "order_id", "customer_id",
                    X.money_out("total_price").alias("total_price"), "created_at", F.col("is_new").alias("new_since_mark")))


def get_queries() -> dict[str, QueryFn]:
    # import for side effects: other plan modules register more queries
    from lifetide.plans import ingest, model, quality  # noqa: F401
    return dict(QUERIES)


__all__ = ["QUERIES", "get_queries", "query", "ORDER_SNAPSHOT_BEFORE"]
