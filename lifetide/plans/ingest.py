"""Ingestion plans: flatten, cursors, dedup, upsert, store fan-in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifetide.functions import scalars as X
from lifetide.operators import dedup as D
from lifetide.operators import flatten as P
from lifetide.operators import quality as Q
from lifetide.operators import upsert as U
from lifetide.plans.catalog import query
from lifetide.schemas import CHECKOUT_PAYLOAD, CUSTOMER_PAYLOAD, MONEY, ORDER_PAYLOAD, ORDERS, TABLES
from lifetide.sources import incremental as I
from lifetide.sources import payloads as PL
from lifetide.sources.bridge import AS_OF, ORDER_SNAPSHOT_BEFORE, RECENT_PAGE_FROM, Bridge, store_of


def _money_as_double(df: DataFrame) -> DataFrame:
    """Reports carry money as DOUBLE (cast once, at the end)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _customers(spark, base):
    return P.flatten_customers(PL.customer_payloads(Bridge(spark, base)))


def _orders(spark, base, with_lines=True):
    return P.flatten_orders(PL.order_payloads(Bridge(spark, base), with_lines=with_lines))


# ------------------------------------------------------------------ flatten
@query("flatten_customers")
def flatten_customers(spark, base):
    return _money_as_double(_customers(spark, base).drop("note"))


@query("marketing_consent")
def marketing_consent(spark, base):
    return _customers(spark, base).select("customer_id", "accepts_marketing")


@query("field_defaults")
def field_defaults(spark, base):
    return _customers(spark, base).select("customer_id", "orders_count", "customer_state",
                                          "verified_email", "tax_exempt", "currency")


@query("tags_json")
def tags_json(spark, base):
    return _customers(spark, base).select("customer_id", "tags")


@query("store_tagging")
def store_tagging(spark, base):
    return _customers(spark, base).select("store_id", "customer_id")


FLAT_ORDER_COLUMNS = [
    "store_id", "order_id", "customer_id", "order_number", "total_price", "subtotal_price",
    "total_tax", "total_discounts", "currency", "financial_status", "test", "taxes_included",
    "total_weight", "total_items", "tags", "shipping_name", "shipping_address1", "shipping_city",
    "shipping_country", "shipping_zip", "created_at", "updated_at", "processed_at", "cancelled_at",
]


@query("flatten_orders")
def flatten_orders(spark, base):
    return _money_as_double(_orders(spark, base).select(*FLAT_ORDER_COLUMNS))


@query("money_parse")
def money_parse(spark, base):
    o = _orders(spark, base, with_lines=False)
    return _money_as_double(o.select("order_id", "total_price", "subtotal_price", "total_tax",
                                     "total_discounts"))


@query("iso_timestamps")
def iso_timestamps(spark, base):
    o = _orders(spark, base, with_lines=False)
    return o.select("order_id", "created_at", "updated_at", "processed_at", "cancelled_at")


FLAT_ITEM_COLUMNS = [
    "store_id", "order_item_id", "order_id", "product_id", "variant_id", "title", "quantity",
    "price", "sku", "requires_shipping", "taxable", "gift_card", "fulfillment_status", "grams",
    "total_discount", "created_at",
]


@query("explode_line_items")
def explode_line_items(spark, base):
    items = P.explode_line_items(PL.order_payloads(Bridge(spark, base), fields=P.ITEM_ORDER_FIELDS))
    return _money_as_double(items.select(*FLAT_ITEM_COLUMNS))


@query("id_normalize")
def id_normalize(spark, base):
    items = P.explode_line_items(PL.order_payloads(Bridge(spark, base), fields=("id", "line_items")))
    return items.select("order_item_id", "order_id", "product_id", "variant_id")


@query("flatten_checkouts")
def flatten_checkouts(spark, base):
    c = P.flatten_checkouts(PL.checkout_payloads(Bridge(spark, base)))
    return _money_as_double(c.select("store_id", "checkout_id", "customer_id", "email", "total_price",
                                     "currency", "completed_at", "created_at", "abandoned_at",
                                     "recovery_url"))


# ------------------------------------------------------------- dedup
def _line_update_feed(b: Bridge) -> DataFrame:
    """Line-item records as delivered: (order, line) repeats; the landing
    sequence of a record is (part, supplier)."""
    li = b.lineitems(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                      "l_extendedprice", "l_discount", "l_shipdate"])
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("variant_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)"))
        .cast(MONEY).alias("total_discount"),
        F.col("l_shipdate").alias("updated_at"),
        (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("ingest_seq"))


@query("latest_per_key")
def latest_per_key(spark, base):
    feed = _line_update_feed(Bridge(spark, base))
    out = D.latest_per_key(feed, ["order_id", "line_number"], ["updated_at", "ingest_seq"],
                           drop=["ingest_seq"])
    return _money_as_double(out)


@query("dedup_keep_last")
def dedup_keep_last(spark, base):
    e = Bridge(spark, base).raw("events", ["event_id", "ts", "user_id", "event_type", "value"])
    feed = e.select(F.col("user_id").cast("string").alias("customer_id"), "event_id",
                    "event_type", "value", "ts")
    return D.dedup_keep_last(feed, ["customer_id"], "event_id")


# ------------------------------------------------------------ upsert (K3-K6)
def _order_update_batch(b: Bridge) -> DataFrame:
    """Order changes staged from the item feed: one record per line, so an
    order arrives several times; the newest ship date wins."""
    li = b.lineitems(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                      "l_shipdate"])
    o = b.raw("orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    status = (F.when(F.col("l_returnflag") == "R", F.lit("refunded"))
              .when(F.col("l_returnflag") == "A", F.lit("paid")).otherwise(F.lit("pending")))
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .select(store_of("o_custkey").alias("store_id"),
                    F.col("o_orderkey").cast("string").alias("order_id"),
                    F.col("o_custkey").cast("string").alias("customer_id"),
                    F.col("o_totalprice").cast(MONEY).alias("total_price"),
                    status.alias("financial_status"),
                    F.col("l_shipdate").alias("updated_at"),
                    "l_linenumber", "l_partkey", "l_suppkey"))


@query("upsert_latest_orders")
def upsert_latest_orders(spark, base):
    b = Bridge(spark, base)
    target = (b.orders().filter(F.col("created_at") < X.ts_lit(ORDER_SNAPSHOT_BEFORE))
              .select("store_id", "order_id", "customer_id", "total_price", "financial_status",
                      "order_priority", "created_at", "updated_at"))
    seq = ["l_linenumber", "l_partkey", "l_suppkey"]
    out = U.upsert(target, _order_update_batch(b), ["store_id", "order_id"],
                   newest_first=["updated_at", *seq], drop=seq)
    return _money_as_double(out)


@query("upsert_partial_customers")
def upsert_partial_customers(spark, base):
    b = Bridge(spark, base)
    target = b.customers().select("store_id", "customer_id", "email", "first_name", "last_name",
                                  "customer_state", "accepts_marketing", "total_spent")
    e = b.raw("events", ["event_id", "ts", "user_id", "event_type", "value"])
    batch = (e.filter(F.col("event_type") == "signup")
             .select(store_of("user_id").alias("store_id"),
                     F.col("user_id").cast("string").alias("customer_id"),
                     F.concat(F.lit("user"), F.col("user_id").cast("string"),
                              F.lit("@signup.example")).alias("email"),
                     (F.col("value") > 50).alias("accepts_marketing"),
                     F.col("ts").alias("updated_at"), "event_id"))
    out = U.upsert(target, batch, ["store_id", "customer_id"],
                   newest_first=["updated_at", "event_id"], drop=["event_id"])
    return _money_as_double(out)


@query("upsert_keep_missing")
def upsert_keep_missing(spark, base):
    b = Bridge(spark, base)
    target = b.customers().select("store_id", "customer_id", "email", "first_name", "last_name",
                                  "total_spent", "orders_count", "status")
    e = b.raw("events", ["event_id", "ts", "user_id", "event_type", "value"])
    batch = (e.filter(F.col("event_type") == "view")
             .select(store_of("user_id").alias("store_id"),
                     F.col("user_id").cast("string").alias("customer_id"),
                     F.when(F.pmod("event_id", F.lit(3)) != 0,
                            F.concat(F.lit("v"), F.col("user_id").cast("string"),
                                     F.lit("@view.example"))).alias("email"),
                     F.lit(None).cast("string").alias("first_name"),
                     F.when(F.pmod("event_id", F.lit(2)) == 0, F.col("value").cast(MONEY))
                     .alias("total_spent"),
                     F.col("ts").alias("updated_at"), "event_id"))
    out = U.upsert_keep_missing(target, batch, ["store_id", "customer_id"],
                                newest_first=["updated_at", "event_id"],
                                new_defaults=U.new_customer_defaults(), drop=["event_id"])
    return _money_as_double(out)


@query("new_orders_only")
def new_orders_only(spark, base):
    b = Bridge(spark, base)
    cols = ["store_id", "order_id", "customer_id", "total_price", "created_at"]
    o = b.orders()
    target = o.filter(F.col("created_at") < X.ts_lit(ORDER_SNAPSHOT_BEFORE)).select(*cols)
    page = (o.filter(F.col("created_at") >= X.ts_lit(RECENT_PAGE_FROM))
            .withColumn("total_price", (F.col("total_price") + F.lit(1)).cast(MONEY))
            .select(*cols))
    fresh = U.insert_if_absent(target, page, ["store_id", "order_id"])
    out = (target.withColumn("origin", F.lit("stored"))
           .unionByName(fresh.withColumn("origin", F.lit("inserted"))))
    return _money_as_double(out)


# ------------------------------------------------------------ cursors
@query("incremental_since_id")
def incremental_since_id(spark, base):
    """Rows above each store's mark (S2) and the marks after them (A14): the
    marks are one row per store, so orders are read twice in all."""
    o = Bridge(spark, base).raw("orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        store_of("o_custkey").alias("store_id"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"))
    marks = I.marks_of(o.filter(F.col("created_at") < X.ts_lit(ORDER_SNAPSHOT_BEFORE)), "id")
    seen = I.flag_new(o.select("store_id", "id"), "id", marks)
    new = F.col("is_new")
    return (seen.groupBy("store_id")
            .agg(F.max("since_id").alias("since_id"), F.count_if(new).alias("rows_read"),
                 F.greatest(F.max("since_id"), F.max(F.when(new, F.col("id")))).alias("next_since_id")))


# ------------------------------------------------------ stores
JUNK_EVERY = 4999          # every order whose key this divides is malformed in the feed


@query("unknown_stores")
def unknown_stores(spark, base):
    b = Bridge(spark, base)
    r = b.raw("region", ["r_regionkey"])
    requests = r.select(F.col("r_regionkey").alias("request_id"), store_of("r_regionkey").alias("store_id")) \
        .unionByName(r.select(F.col("r_regionkey").alias("request_id"),
                              F.concat(F.lit("store_"), (F.col("r_regionkey") + 3).cast("string"))
                              .alias("store_id")))
    return Q.unknown_stores(requests, b.customers())


@query("store_status")
def store_status(spark, base):
    """Counts and state of every store of the registry: 'error' where the last load of the order feed set rows aside (A10)."""
    from lifetide.operators import reports as R
    b = Bridge(spark, base)
    r = b.raw("region", ["r_regionkey"])
    registry = r.select(store_of("r_regionkey").alias("store_id")).unionByName(
        r.select(F.concat(F.lit("store_"), (F.col("r_regionkey") + 3).cast("string")).alias("store_id")))
    feed = PL.order_payloads(b, with_lines=False, junk_every=JUNK_EVERY, fields=("id", "total_price", "created_at"))
    loaded = Q.load_status(Q.flag(P.parse(feed, ORDER_PAYLOAD), "orders"), "orders")
    return R.store_status(b.customers(), b.orders(), registry, loaded)


@query("store_load_status")
def store_load_status(spark, base):
    """Every resource's rows per store, loaded and set aside, from the feeds (K9)."""
    b = Bridge(spark, base)
    orders = Q.flag(P.parse(PL.order_payloads(b, junk_every=JUNK_EVERY), ORDER_PAYLOAD), "orders")
    customers = Q.flag(P.parse(PL.customer_payloads(b), CUSTOMER_PAYLOAD), "customers")
    checkouts = Q.flag(P.parse(PL.checkout_payloads(b), CHECKOUT_PAYLOAD), "abandoned_checkouts")
    return (_orders_and_items(orders)
            .unionByName(Q.load_status(customers, "customers"))
            .unionByName(Q.load_status(checkouts, "abandoned_checkouts", F.col("p.completed_at").isNull())))


def _orders_and_items(flagged: DataFrame) -> DataFrame:
    """Load status of orders and of the items of the good ones, from one pass over the order feed."""
    bad = F.col("quarantined")
    items = F.when(~bad, F.col("p.line_items"))
    aside = F.size(F.filter(items, lambda li: Q.is_bad(li, "order_items")))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    head = F.coalesce(F.col("p.line_page"), F.lit(0)) == 0
    per_order = flagged.select("store_id", F.array(
        F.struct(F.lit("orders").alias("table_name"), (~bad & head).cast("long").alias("loaded"), bad.cast("long").alias("aside")),
        F.struct(F.lit("order_items").alias("table_name"), n(F.size(items) - aside).alias("loaded"), n(aside).alias("aside"))).alias("fates"))
    # (outer: for a plain explode the optimizer filters on the size of the array, with every check and parse in that filter)
    fate = per_order.select("store_id", F.explode_outer("fates").alias("f")).select("store_id", "f.*")
    return (fate.groupBy("store_id", "table_name").agg(F.sum("loaded").alias("rows_loaded"), F.sum("aside").alias("rows_quarantined"))
            .filter("table_name <> 'order_items' or rows_loaded + rows_quarantined > 0")
            .withColumn("success", F.col("rows_quarantined") == 0))


# ------------------------------------------------------ refunds (S4), stored metrics
@query("flatten_refunds")
def flatten_refunds(spark, base):
    return _money_as_double(P.flatten_refunds(PL.refund_payloads(Bridge(spark, base)))
                            .drop("status", "note", "processed_at"))


@query("returns")
def returns(spark, base):
    """The returns view over the refunds table."""
    from lifetide.plans.sync import RETURNS
    b = Bridge(spark, base)
    o = b.orders().select("store_id", "order_id", "customer_id")
    refunds = U.conform(b.refunds().join(o, "order_id", "inner"), "refunds")
    return _money_as_double(spark.sql(RETURNS.format(refunds="{refunds}"), refunds=refunds)).select(
        "return_id", "store_id", "order_id", "customer_id", "return_date", "refund_amount", "currency")


@query("customer_metrics_table")
def customer_metrics_table(spark, base):
    """The rows that a sync stores in customer_metrics."""
    from lifetide.operators import metrics as M
    from lifetide.plans.sync import customer_metrics_rows
    b = Bridge(spark, base)
    profile = M.clv_profile(b.customers(), b.orders(), b.abandoned_checkouts(), b.refunds())
    return U.conform(customer_metrics_rows(profile, AS_OF), "customer_metrics").drop(
        "predicted_clv", "clv_confidence_score", "last_prediction_date")


@query("distinct_counts_merged")
def distinct_counts_merged(spark, base):
    """Distinct products and buyers per store, from bitmaps per year of shipping (orders: of ordering) merged by OR (A2)."""
    from lifetide.operators import distinct as DC
    b = Bridge(spark, base)
    o = b.raw("orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        "o_orderkey", "o_custkey", store_of("o_custkey").alias("store_id"), F.year("o_orderdate").alias("year"))
    sold = b.lineitems(["l_orderkey", "l_partkey", "l_shipdate"]).select("l_orderkey", "l_partkey", F.year("l_shipdate").alias("shipped")).join(
        o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    products = DC.bitmaps(sold, ["store_id", "shipped"], "l_partkey")
    buyers = DC.bitmaps(o, ["store_id", "year"], "o_custkey")
    return (DC.counts(products, ["store_id"], "products").join(DC.counts(buyers, ["store_id"], "buyers"), "store_id", "full_outer")
            .select("store_id", F.coalesce("products", F.lit(0)).alias("products"), F.coalesce("buyers", F.lit(0)).alias("buyers")))


# ------------------------------------------------------ alignment, stamps, catalog
@query("aligned_orders")
def aligned_orders(spark, base):
    """Raw order columns under the canonical names and types (P13, X7), stamped
    once per run (P12), times as text for a text-only sink (P14)."""
    raw = Bridge(spark, base).raw("orders").select(
        store_of("o_custkey").alias("STORE_ID"), F.col("o_orderkey").alias("ORDER_ID"), F.col("o_totalprice").alias("Total_Price"),
        F.col("o_orderdate").alias("CREATED_AT"), F.col("o_orderpriority").alias("not_in_the_table"))
    return _money_as_double(P.as_text_columns(P.stamp(P.align_to(raw, ORDERS), AS_OF)))


@query("column_listing")
def column_listing(spark, base):
    """Canonical columns of the model's tables (V1): type, and how many rows hold a value."""
    b = Bridge(spark, base)
    parts = []
    for name, df in (("customers", b.customers()), ("orders", b.orders()), ("abandoned_checkouts", b.abandoned_checkouts())):
        listed = Q.column_listing(df, spark, TABLES[name], counted=True).filter(F.col("matches_canonical"))
        parts.append(listed.select(F.lit(name).alias("table_name"), "column_name", "data_type", "n_values"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("expected_names")
def expected_names(spark, base):
    """Expected names against found ones, whatever their case (F5, V2, U2),
    in order (O4): the nations' names are expected, the customers' countries found."""
    b = Bridge(spark, base)
    expected = b.raw("nation", ["n_name"]).select(F.upper("n_name").alias("name"))
    found = b.customers().select(F.col("country").alias("name"))
    return Q.compare_names(expected, found)
