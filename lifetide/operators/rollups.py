"""Customer roll-ups kept by differences.

A batch that stores rows takes the old version of every row out of its customer's
roll-up and puts the new one in: counts and sums by signed sums, the first and
last order by comparison.  Only when an order that held the first or last date
leaves (changed, or moved to another customer) are that customer's orders read
again.  The same batch again has equal old and new versions, so it changes
nothing; an order moved from one customer to another leaves the one and enters
the other, its refunds with it.

Old versions are read from the buckets that the batch touches.  Every difference is a partial
aggregate by customer, so a hot customer is one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators import upsert as U
from lifetide.operators.metrics import CUSTOMER_KEY
from lifetide.operators.publish import Run
from lifetide.schemas import MONEY

SUMS = ("n_orders", "spent", "checkouts", "refunds", "refunded")
DATES = ("first_out", "last_out", "first_in", "last_in")


def _zero():
    return F.lit(0).cast(MONEY)


def _shaped(df: DataFrame, **columns) -> DataFrame:
    """(customer key, all sums, all dates), those not named being nothing."""
    out = [*CUSTOMER_KEY]
    for c in SUMS:
        kind = MONEY if c in ("spent", "refunded") else "long"
        out.append(F.coalesce(columns.get(c, F.lit(0)), F.lit(0)).cast(kind).alias(c))
    for c in DATES:
        out.append(columns.get(c, F.lit(None)).cast("timestamp_ntz").alias(c))
    return df.filter(F.col("customer_id").isNotNull()).select(*out)


def order_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Differences of a batch of orders (``before``: their stored versions)."""
    paid = F.coalesce("total_price", _zero())
    out = _shaped(before, n_orders=F.lit(-1), spent=-paid, first_out=F.col("created_at"), last_out=F.col("created_at"))
    new = _shaped(after, n_orders=F.lit(1), spent=paid, first_in=F.col("created_at"), last_in=F.col("created_at"))
    return out.unionByName(new)


def checkout_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Differences of a batch of abandoned checkouts."""
    return _shaped(before, checkouts=F.lit(-1)).unionByName(_shaped(after, checkouts=F.lit(1)))


def refund_changes(before: DataFrame, after: DataFrame, orders: DataFrame) -> DataFrame:
    """Differences of a batch of refunds, on the customers of their ``orders``."""
    signed = before.select("store_id", "order_id", F.lit(-1).alias("s"), "amount").unionByName(
        after.select("store_id", "order_id", F.lit(1).alias("s"), "amount"))
    per_order = signed.groupBy("store_id", "order_id").agg(
        F.sum("s").alias("n"), F.sum(F.col("s") * F.coalesce("amount", _zero())).alias("amount"))
    owned = per_order.join(orders.select("store_id", "order_id", "customer_id"), ["store_id", "order_id"], "inner")
    return _shaped(owned, refunds=F.col("n"), refunded=F.col("amount"))


def refunds_that_move(before: DataFrame, after: DataFrame, refunds: DataFrame) -> DataFrame:
    """Differences of stored ``refunds`` whose orders came (after the refund) or changed their customer."""
    old = before.select("store_id", "order_id", F.col("customer_id").alias("was"))
    moved = (after.select("store_id", "order_id", "customer_id").join(old, ["store_id", "order_id"], "left")
             .filter(~F.col("customer_id").eqNullSafe(F.col("was"))))
    per_order = (refunds.join(moved.select("store_id", "order_id"), ["store_id", "order_id"], "left_semi")
                 .groupBy("store_id", "order_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("amount", _zero())).alias("amount")))
    both = moved.join(per_order, ["store_id", "order_id"], "inner")
    leave = _shaped(both.withColumn("customer_id", F.col("was")), refunds=-F.col("n"), refunded=-F.col("amount"))
    return leave.unionByName(_shaped(both, refunds=F.col("n"), refunded=F.col("amount")))


def per_customer(changes: DataFrame) -> DataFrame:
    least, most = ("first_out", "first_in"), ("last_out", "last_in")
    return changes.groupBy(*CUSTOMER_KEY).agg(
        *[F.sum(c).alias(f"d_{c}") for c in SUMS], *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most])


def updated(run: Run, path: str, changes: DataFrame, orders: DataFrame | None, as_of) -> DataFrame:
    """New roll-ups of the customers that ``changes`` name; ``emptied``: their last order left.

    ``path``: the stored roll-ups.  ``orders``: all orders as they will be stored, read only for customers whose first or last order left."""
    d = run.scratch(per_customer(changes))
    stored = U.touched_rows(run.spark, path, "customer_rollups", d)
    j = d.join(stored, CUSTOMER_KEY, "left")
    had = F.coalesce("n_orders", F.lit(0))
    count = had + F.col("d_n_orders")
    left_first = (F.col("first_out") <= F.col("first_order_date")) & (F.col("first_in").isNull() | (F.col("first_in") > F.col("first_order_date")))
    left_last = (F.col("last_out") >= F.col("last_order_date")) & (F.col("last_in").isNull() | (F.col("last_in") < F.col("last_order_date")))
    rows = run.scratch(j.select(
        *CUSTOMER_KEY, count.alias("n_orders"), *[(F.coalesce(F.col(c), F.lit(0)) + F.col(f"d_{c}")).alias(c) for c in SUMS[1:]],
        F.when(count > 0, F.least("first_order_date", "first_in")).alias("first_order_date"),
        F.when(count > 0, F.greatest("last_order_date", "last_in")).alias("last_order_date"),
        (F.coalesce(left_first | left_last, F.lit(False)) & (count > 0)).alias("again"), ((had > 0) & (count == 0)).alias("emptied")))
    U.release(stored)
    again = rows.filter("again").select(*CUSTOMER_KEY)
    if orders is not None and not again.isEmpty():
        found = (orders.select(*CUSTOMER_KEY, "created_at").join(again, CUSTOMER_KEY, "left_semi")
                 .groupBy(*CUSTOMER_KEY).agg(F.min("created_at").alias("first_again"), F.max("created_at").alias("last_again")))
        rows = rows.join(found, CUSTOMER_KEY, "left").select(
            *CUSTOMER_KEY, *SUMS, "emptied", F.when(F.col("again"), F.col("first_again")).otherwise(F.col("first_order_date")).alias("first_order_date"),
            F.when(F.col("again"), F.col("last_again")).otherwise(F.col("last_order_date")).alias("last_order_date"))
    return rows.select(*CUSTOMER_KEY, F.col("n_orders").cast("long").alias("n_orders"), F.col("spent").cast(MONEY).alias("spent"), "first_order_date",
                       "last_order_date", F.col("checkouts").cast("long").alias("checkouts"), F.col("refunds").cast("long").alias("refunds"),
                       F.col("refunded").cast(MONEY).alias("refunded"), X.ts_lit(as_of).alias("updated_at"), "emptied")


def replaced(stored: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """A table as it will be once ``after`` is merged into it."""
    keys = ["store_id", key]
    return stored.select(*after.columns).join(after.select(*keys), keys, "left_anti").unionByName(after)


# ------------------------------------------------------------ derived tables
def customer_rows(known: DataFrame, rollups: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Rows that bring ``known`` customers (key, status) up to date: those that have orders or have lost their last one, and the status
    of the others (who keep the count and spend of the shop's record)."""
    rolled = F.col("n_orders").isNotNull() & ((F.col("n_orders") > 0) | F.col("emptied"))
    j = known.join(rollups, CUSTOMER_KEY, "left")
    stamped = (X.status(F.col("last_order_date"), as_of, F.col("status")).alias("status"), X.ts_lit(as_of).alias("updated_at"))
    with_orders = j.filter(rolled).select(*CUSTOMER_KEY, F.col("n_orders").cast("int").alias("orders_count"), F.col("spent").alias("total_spent"),
                                          "first_order_date", "last_order_date", *stamped)
    return with_orders, j.filter(~F.coalesce(rolled, F.lit(False))).select(*CUSTOMER_KEY, *stamped)


def metric_rows(known: DataFrame, rollups: DataFrame, as_of) -> DataFrame:
    """Rows of customer_metrics (without predictions) of ``known`` customers."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    money = lambda c: X.money_out(F.coalesce(F.col(c), _zero()))
    return (known.select(*CUSTOMER_KEY).join(rollups, CUSTOMER_KEY, "left").select(
        *CUSTOMER_KEY, n("n_orders").alias("total_orders"), money("spent").alias("total_spent"),
        X.guarded_ratio(F.coalesce("spent", _zero()), n("n_orders")).alias("average_order_value"), "first_order_date", "last_order_date",
        n("checkouts").alias("abandoned_checkouts_count"), n("refunds").alias("refunds_count"), money("refunded").alias("total_refunded"))
        .withColumn("refund_rate", X.guarded_ratio("total_refunded", "total_spent")).withColumn("updated_at", X.ts_lit(as_of)))


def stage_derived(run: Run, touched: DataFrame, new_rollups: DataFrame | None, arriving: DataFrame | None, as_of) -> None:
    """Stage customers and customer_metrics of the ``touched`` customers that are stored, or ``arriving`` in this run."""
    touched = run.scratch(touched.select(*CUSTOMER_KEY).filter(F.col("customer_id").isNotNull()).distinct())
    if touched.isEmpty():
        return
    stored = U.touched_rows(run.spark, f"{run.root}/customer_rollups", "customer_rollups", touched)
    rollups = stored.drop("key_bucket").withColumn("emptied", F.lit(False))
    if new_rollups is not None:
        rollups = rollups.join(new_rollups.select(*CUSTOMER_KEY), CUSTOMER_KEY, "left_anti").unionByName(new_rollups)
    there = U.touched_rows(run.spark, f"{run.root}/customers", "customers", touched)
    known = there.select(*CUSTOMER_KEY, "status")
    if arriving is not None:
        known = known.unionByName(arriving.select(*CUSTOMER_KEY).distinct().join(known, CUSTOMER_KEY, "left_anti")
                                  .withColumn("status", F.lit(None).cast("string")))
    known, rollups = run.scratch(known), run.scratch(rollups)
    U.release(stored, there)
    for rows in customer_rows(known, rollups, as_of):
        run.stage("customers", rows)
    run.stage("customer_metrics", metric_rows(known, rollups, as_of))
