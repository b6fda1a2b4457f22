"""Shop-API style JSON payloads derived from the driver tables.

The flatten, upsert and streaming jobs consume nested JSON text as the shop
API delivers it.  These feeds render every driver row as such a payload,
with the variety real feeds have: missing objects, '' and NULL amounts,
ISO times with 'Z' or offsets, guest orders, empty and absent item lists.
Which row gets which variant is a fixed rule of the row's key, so the SQL
twins in ``lifetide.plans.oracle`` can state the expected flat values
directly from the tables.

Each feed returns ``(store_id, payload)``: the store is the landing folder
a page came from, the payload is JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifetide.schemas import MONEY
from lifetide.sources.bridge import Bridge, store_of

# The variant rules (key mod n) of the payload feeds.
CUSTOMER_EPOCH = "1994-01-01 00:00:00"
CUSTOMER_SPACING_SECONDS = 3607
LINE_PAGE_SIZE = 250                       # API page size, also about the line items per payload
STATES = ["enabled", "disabled", "invited"]   # k % 4 == 3 leaves the state out


def _k(name: str) -> Column:
    return F.col(name)


def _mod(c: Column, n: int) -> Column:
    return F.pmod(c, F.lit(n))


def iso_text(ts: Column, key: Column, with_fraction: bool = False) -> Column:
    """Render a UTC instant as ISO text in one of three zones, by key mod 3:
    0 -> 'Z', 1 -> local time at -05:00, 2 -> local time at +02:00."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss" + (".SSSSSS" if with_fraction else "")
    z = F.concat(F.date_format(ts, fmt), F.lit("Z"))
    west = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(-5), ts), fmt), F.lit("-05:00"))
    east = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(2), ts), fmt), F.lit("+02:00"))
    m = _mod(key, 3)
    return F.when(m == 0, z).when(m == 1, west).otherwise(east)


def money_text(x: Column) -> Column:
    return x.cast(MONEY).cast("string")


def customer_created(key: Column) -> Column:
    return F.timestamp_add("SECOND", key * CUSTOMER_SPACING_SECONDS,
                           F.to_timestamp_ntz(F.lit(CUSTOMER_EPOCH)))


def customer_payloads(b: Bridge) -> DataFrame:
    c = b.raw("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = b.raw("nation", ["n_nationkey", "n_name"])
    k = _k("c_custkey")
    created = customer_created(k)
    state = F.when(_mod(k, 4) == 0, F.lit(STATES[0])).when(_mod(k, 4) == 1, F.lit(STATES[1])) \
        .when(_mod(k, 4) == 2, F.lit(STATES[2]))
    payload = F.struct(
        k.alias("id"),
        F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(_mod(k, 8) != 0, _mod(k, 20).cast("int")).alias("orders_count"),
        F.when(_mod(k, 13) == 0, F.lit("")).when(_mod(k, 17) != 0, money_text(F.col("c_acctbal")))
        .alias("total_spent"),
        F.when(_mod(k, 11) != 0, iso_text(created, k)).alias("created_at"),
        F.when(_mod(k, 11) != 0, F.concat(F.date_format(
            F.timestamp_add("DAY", F.lit(1), created), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .alias("updated_at"),
        state.alias("state"),
        F.when(_mod(k, 4) == 1, k * 10).when(_mod(k, 4) == 2, F.lit(0)).alias("last_order_id"),
        F.when(_mod(k, 5) != 0, F.lit(True)).alias("verified_email"),
        F.when(_mod(k, 9) == 0, F.lit(True)).alias("tax_exempt"),
        F.when(_mod(k, 6) != 0, F.col("c_mktsegment")).alias("tags"),
        F.when(_mod(k, 7) != 0, F.struct(
            F.when(_mod(k, 3) == 0, F.lit("subscribed")).otherwise(F.lit("not_subscribed"))
            .alias("state"))).alias("email_marketing_consent"),
        F.when(_mod(k, 10) != 3, F.struct(
            F.col("n_name").alias("country"),
            F.concat(F.lit("P"), _mod(k, 50).cast("string")).alias("province"),
            F.concat(F.lit("City"), _mod(k, 100).cast("string")).alias("city"),
            F.lpad(_mod(k, 100000).cast("string"), 5, "0").alias("zip"))).alias("default_address"),
    )
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(store_of("c_custkey").alias("store_id"), F.to_json(payload).alias("payload")))


def _line_pages(b: Bridge) -> DataFrame:
    """Line items as JSON-ready structs, grouped into pages of about
    LINE_PAGE_SIZE lines per order.  The page of a line is a hash of the
    line modulo the order's page count, so even an order holding a third of
    all lines is split into bounded pages; no group grows with the data.
    Page 0 heads the order: it carries the order's line count, so an order is
    one row however many pages its items take.  (A page expects over 125
    lines, so none is empty but with a chance below e^-125.)"""
    li = b.lineitems(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                      "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate"])
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    pages = F.greatest(F.ceil(F.col("n_lines") / F.lit(LINE_PAGE_SIZE)), F.lit(1))
    page = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"), pages)
    k = _k("l_orderkey")
    item = F.struct(
        (k * 1000 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("variant_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("title"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(_mod(F.col("l_partkey"), 19) != 0, money_text(F.col("l_extendedprice"))).alias("price"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.when(F.col("l_linestatus") == "F", F.lit("fulfilled")).alias("fulfillment_status"),
        F.when(_mod(F.col("l_partkey"), 3) == 0, F.lit(False)).alias("taxable"),
        (F.col("l_quantity") * 100).cast("int").alias("grams"),
        money_text(F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)"))
        .alias("total_discount"),
    )
    return (li.join(per_order, "l_orderkey")
            .groupBy("l_orderkey", page.alias("page"), "n_lines")
            .agg(F.collect_list(item).alias("line_items")))


def order_payloads(b: Bridge, with_lines: bool = True, junk_every: int | None = None,
                   fields: tuple[str, ...] | None = None) -> DataFrame:
    """Order payloads; ``junk_every=n`` makes the total of every order whose
    key is a multiple of n unreadable ('n/a'), as a malformed feed would.
    ``fields`` renders only these top-level fields."""
    o = b.raw("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         "o_orderdate", "o_orderpriority"])
    k = _k("o_orderkey")
    created = F.col("o_orderdate")
    fin = (F.when(F.col("o_orderstatus") == "F", F.lit("paid"))
           .when(F.col("o_orderstatus") == "O", F.lit("pending"))
           .when(F.col("o_orderstatus") == "P", F.lit("refunded")))
    if with_lines:
        # one row per page and one for an order without lines; pages are
        # about LINE_PAGE_SIZE times fewer than lines
        pages = _line_pages(b)
        o = o.join(pages, pages.l_orderkey == o.o_orderkey, "left").drop("l_orderkey")
        empty = F.from_json(F.lit("[]"), pages.schema["line_items"].dataType)
        lines = F.when(F.col("line_items").isNotNull(), F.col("line_items")) \
            .when(_mod(k, 2) == 0, empty)
    payload_fields = [
        k.alias("id"),
        F.concat(F.lit("#"), k.cast("string")).alias("name"),
        F.when(_mod(k, 9) != 0, k).alias("order_number"),
        F.when(_mod(k, 50) != 0, F.struct(F.col("o_custkey").alias("id"))).alias("customer"),
        (F.when(_mod(k, junk_every) == 0, F.lit("n/a")) if junk_every else F.when(F.lit(False), F.lit("")))
        .when(_mod(k, 31) != 0, money_text(F.col("o_totalprice"))).otherwise(F.lit(""))
        .alias("total_price"),
        F.when(_mod(k, 4) == 0, F.lit("5.00")).alias("total_discounts"),
        fin.alias("financial_status"),
        iso_text(created, k).alias("created_at"),
        F.concat(F.date_format(F.timestamp_add("HOUR", _mod(k, 48), created), "yyyy-MM-dd'T'HH:mm:ss"),
                 F.lit("Z")).alias("updated_at"),
        F.concat(F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("processed_at"),
        F.when((F.col("o_orderstatus") == "P") & (_mod(k, 5) == 0),
               F.concat(F.date_format(F.timestamp_add("DAY", F.lit(1), created), "yyyy-MM-dd'T'HH:mm:ss"),
                        F.lit("Z"))).alias("cancelled_at"),
        F.col("o_orderpriority").alias("tags"),
        F.when(_mod(k, 10) != 7, F.struct(
            F.concat(F.lit("cust"), F.col("o_custkey").cast("string")).alias("name"),
            F.concat(k.cast("string"), F.lit(" Main St")).alias("address1"),
            F.concat(F.lit("City"), _mod(F.col("o_custkey"), 100).cast("string")).alias("city"),
            F.lit("US").alias("country"),
            F.lpad(_mod(F.col("o_custkey"), 100000).cast("string"), 5, "0").alias("zip")))
        .alias("shipping_address"),
    ]
    if with_lines:
        many = F.col("n_lines") > LINE_PAGE_SIZE
        payload_fields += [lines.alias("line_items"), F.when(many, F.col("n_lines")).alias("line_items_count"),
                           F.when(many, F.col("page").cast("int")).alias("line_page")]
    payload = F.struct(*payload_fields)
    if fields:
        payload = F.struct(*[payload[f].alias(f) for f in fields])
    return o.select(store_of("o_custkey").alias("store_id"), F.to_json(payload).alias("payload"))


def refund_payloads(b: Bridge) -> DataFrame:
    """Returned lines as refund payloads, landed under the store of their order's customer."""
    li = b.lineitems(["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]) \
        .filter(F.col("l_returnflag") == "R")
    o = b.raw("orders", ["o_orderkey", "o_custkey"])
    k = _k("l_orderkey")
    amount = (F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY)
    payload = F.struct(
        (k * 1000 + F.col("l_linenumber")).alias("id"), k.alias("order_id"),
        F.when(_mod(k, 50) != 0, F.struct(F.col("o_custkey").alias("id"))).alias("customer"),
        F.when(_mod(k, 23) == 0, F.lit("")).otherwise(money_text(amount)).alias("amount"),
        F.when(_mod(k, 3) == 0, F.lit("EUR")).alias("currency"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("reason"),
        F.when(_mod(k, 4) == 0, F.lit(True)).alias("restock"),
        iso_text(F.col("l_shipdate"), k).alias("created_at"))
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .select(store_of("o_custkey").alias("store_id"), F.to_json(payload).alias("payload")))


def checkout_payloads(b: Bridge) -> DataFrame:
    e = b.raw("events", ["event_id", "ts", "user_id", "event_type", "value"])
    k = _k("event_id")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    payload = F.struct(
        k.alias("id"),
        F.when(_mod(k, 25) != 0, F.struct(F.col("user_id").alias("id"))).alias("customer"),
        F.concat(F.lit("customer"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        money_text(F.col("value")).alias("total_price"),
        F.when(F.col("event_type") == "purchase", F.concat(F.date_format("ts", fmt), F.lit("Z")))
        .alias("completed_at"),
        iso_text(F.col("ts"), k, with_fraction=True).alias("created_at"),
        F.concat(F.lit("https://shop.example/recover/"), k.cast("string")).alias("recovery_url"),
    )
    return (e.filter(F.col("event_type").isin("click", "purchase"))
            .select(store_of("user_id").alias("store_id"), F.to_json(payload).alias("payload")))
