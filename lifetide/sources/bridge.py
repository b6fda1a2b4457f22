"""Commerce model tables derived from the driver's TPC-H-style tables.

The driver ships ``customer``, ``orders``, ``lineitem``, ``part``, ``nation``
and ``events``; the library works on the commerce model of
``lifetide.schemas``.  This module is the one mapping between the two; every
query reads the whole driver tables through it.

Mapping (each rule is repeated in SQL text in ``lifetide.plans.oracle``):

* store_id   = 'store_' || (customer key mod 5) -- a pure function of the
  customer key, so every table derives its store locally with no join.
* customers  <- customer (+ nation name as country; nation has 25 rows by
  the TPC-H definition, so Spark broadcasts it on its own size check)
* orders     <- orders; money cast to DECIMAL(18,2); F/O/P -> paid/pending/refunded
* order_items<- lineitem (+ part for title and unit price)
* refunds    <- lineitem rows with return flag 'R'; amount = extended price
  x (1 - discount), cast to DECIMAL before multiplying
* checkouts  <- events of type click/purchase; purchases are completed
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.schemas import MONEY
from lifetide.sources.tables import read_table

# Fixed values of the bridge.
N_STORES = 5
AS_OF = "2001-08-02 00:00:00"          # order data ends 2001-08-01
ORDER_SNAPSHOT_BEFORE = "2001-01-01 00:00:00"   # orders stored at the previous sync
RECENT_PAGE_FROM = "2000-06-01 00:00:00"        # first day of a re-delivered order page
FINANCIAL_STATUS = {"F": "paid", "O": "pending", "P": "refunded"}


def store_of(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("store_"), F.pmod(k, F.lit(N_STORES)).cast("string"))


def item_key() -> Column:
    """Row key of a line item / refund: order, line, part, supplier, ship day.

    (order, line) alone is not unique in the driver data."""
    return F.concat_ws(
        "-",
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.date_format("l_shipdate", "yyyyMMdd"),
    )


def _fin_status(col: str) -> Column:
    expr = F.lit(None).cast("string")
    for k, v in FINANCIAL_STATUS.items():
        expr = F.when(F.col(col) == k, F.lit(v)).otherwise(expr)
    return expr


class Bridge:
    """Lazy views of the commerce model over one driver data folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def raw(self, name: str, columns: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.base, name, columns)

    # ----------------------------------------------------------- customers
    def customers(self) -> DataFrame:
        c = self.raw("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
        n = self.raw("nation", ["n_nationkey", "n_name"])
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                .select(
                    store_of("c_custkey").alias("store_id"),
                    F.col("c_custkey").cast("string").alias("customer_id"),
                    F.concat(F.lit("customer"), F.col("c_custkey").cast("string"),
                             F.lit("@example.com")).alias("email"),
                    F.col("c_mktsegment").alias("first_name"),
                    F.col("c_name").alias("last_name"),
                    F.when(F.col("c_acctbal") < 0, F.lit("disabled"))
                     .otherwise(F.lit("enabled")).alias("customer_state"),
                    (F.col("c_acctbal") > 5000).alias("accepts_marketing"),
                    F.col("c_acctbal").cast(MONEY).alias("total_spent"),
                    F.lit(0).alias("orders_count"),
                    F.lit("new").alias("status"),
                    F.lit("USD").alias("currency"),
                    F.col("n_name").alias("country"),
                ))

    # -------------------------------------------------------------- orders
    def orders(self) -> DataFrame:
        o = self.raw("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                "o_orderdate", "o_orderpriority"])
        return o.select(
            store_of("o_custkey").alias("store_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_orderkey").cast("string").alias("order_number"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_totalprice").cast(MONEY).alias("total_price"),
            _fin_status("o_orderstatus").alias("financial_status"),
            F.col("o_orderpriority").alias("order_priority"),
            F.lit("USD").alias("currency"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )

    # --------------------------------------------------------- order items
    def lineitems(self, columns: list[str]) -> DataFrame:
        return self.raw("lineitem", columns)

    def order_items(self, with_part: bool = True) -> DataFrame:
        """Line items; ``with_part`` adds title and unit price from ``part``."""
        cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_shipdate"]
        li = self.lineitems(cols)
        out = [
            item_key().alias("order_item_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("variant_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)"))
            .cast(MONEY).alias("total_discount"),
            F.col("l_shipdate").alias("updated_at"),
        ]
        if with_part:
            p = self.raw("part", ["p_partkey", "p_name", "p_retailprice"])
            li = li.join(p, li.l_partkey == p.p_partkey, "left")
            out += [F.col("p_name").alias("title"), F.col("p_retailprice").cast(MONEY).alias("price")]
        return li.select(*out)

    def products(self) -> DataFrame:
        """Product catalogue: product_id, title, unit price (from ``part``)."""
        p = self.raw("part", ["p_partkey", "p_name", "p_retailprice"])
        return p.select(F.col("p_partkey").cast("string").alias("product_id"),
                        F.col("p_name").alias("title"),
                        F.col("p_retailprice").cast(MONEY).alias("price"))

    # ------------------------------------------------------------- refunds
    def refunds(self) -> DataFrame:
        li = self.lineitems(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                             "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])
        return (li.filter(F.col("l_returnflag") == "R")
                .select(
                    item_key().alias("refund_id"),
                    F.col("l_orderkey").cast("string").alias("order_id"),
                    (F.col("l_extendedprice").cast(MONEY)
                     * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY).alias("amount"),
                    F.lit("USD").alias("currency"),
                    F.col("l_shipdate").alias("created_at"),
                ))

    # ----------------------------------------------------------- checkouts
    def checkouts(self) -> DataFrame:
        """All checkouts, completed or not (purchase events are completed)."""
        e = self.raw("events", ["event_id", "ts", "user_id", "event_type", "value"])
        delay = F.pmod(F.col("event_id") * 37, F.lit(3300)) + 300
        return (e.filter(F.col("event_type").isin("click", "purchase"))
                .select(
                    store_of("user_id").alias("store_id"),
                    F.col("event_id").cast("string").alias("checkout_id"),
                    F.col("user_id").cast("string").alias("customer_id"),
                    F.concat(F.lit("customer"), F.col("user_id").cast("string"),
                             F.lit("@example.com")).alias("email"),
                    F.col("value").cast(MONEY).alias("total_price"),
                    F.lit("USD").alias("currency"),
                    F.when(F.col("event_type") == "purchase", F.col("ts")).alias("completed_at"),
                    F.col("ts").alias("created_at"),
                    F.timestamp_add("SECOND", delay, F.col("ts")).alias("abandoned_at"),
                ))

    def abandoned_checkouts(self) -> DataFrame:
        """Checkouts never completed (F1) -- the stored table."""
        return self.checkouts().filter(F.col("completed_at").isNull())


def register_views(spark: SparkSession, base: str) -> list[str]:
    """Register the commerce model of ``base`` as temporary SQL views
    (customers, orders, order_items, abandoned_checkouts, refunds, products)
    so report SQL can be run with ``spark.sql`` unchanged.  Views are lazy:
    each query still reads the driver tables."""
    b = Bridge(spark, base)
    views = {
        "customers": b.customers(),
        "orders": b.orders(),
        "order_items": b.order_items(with_part=True),
        "abandoned_checkouts": b.abandoned_checkouts(),
        "refunds": b.refunds(),
        "products": b.products(),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
