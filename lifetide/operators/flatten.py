"""Nested shop payloads -> flat model rows.

Input: a DataFrame with ``store_id`` and a JSON text column ``payload`` (or
an already parsed struct column ``p``).  Output: canonical columns.  All
work is built-in expressions over the parsed struct: one narrow stage, no
shuffle, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifetide.functions import scalars as X
from lifetide.schemas import CHECKOUT_PAYLOAD, CUSTOMER_PAYLOAD, ORDER_PAYLOAD, REFUND_PAYLOAD

# Per-field defaults when a payload leaves a field out.
DEFAULT_CURRENCY = "USD"
DEFAULT_CUSTOMER_STATE = "enabled"


# The member of an order's payload that makes it a later page of the order's items (inside a text its quotes are escaped).
LATER_PAGE = r'"line_page"\s*:\s*"?0*[1-9]'


def parse(df: DataFrame, schema: T.StructType, col: str = "payload") -> DataFrame:
    """Add the parsed payload as struct column ``p`` (explicit schema, no
    inference).  Malformed JSON yields a NULL ``p`` (PERMISSIVE mode) which
    the quarantine step picks up."""
    if "p" in df.columns:
        return df
    return df.withColumn("p", F.from_json(F.col(col), schema))


def _p(path: str) -> Column:
    return F.col(f"p.{path}")


def _store(df: DataFrame) -> Column:
    return F.col("store_id") if "store_id" in df.columns else F.lit(None).cast("string")


def _arrival(df: DataFrame) -> list[Column]:
    """The arrival sequence of a landed record, where there is one."""
    return [F.col("ingest_seq")] if "ingest_seq" in df.columns else []


def flatten_customers(df: DataFrame, defaults: bool = True, strict: bool = True) -> DataFrame:
    """Customer payload -> customers row.

    The nested default_address yields NULL country/province/city/zip when
    absent; the marketing flag comes from the consent object (False when
    absent); the API field ``state`` lands in ``customer_state``.
    ``defaults=False`` leaves missing fields NULL (and money unparsed-missing
    as NULL) so an update can keep stored values (K6).  ``strict`` (here and
    below): junk money raises; without it, it is NULL and the row is expected
    to be flagged (K9)."""
    df = parse(df, CUSTOMER_PAYLOAD)
    consent = _p("email_marketing_consent")

    def d(col: Column, default) -> Column:
        return F.coalesce(col, F.lit(default)) if defaults else col

    marketing = F.when(consent.isNotNull(), X.consent_flag(_p("email_marketing_consent.state"))) \
        .otherwise(d(_p("accepts_marketing"), False))
    spent = X.money(_p("total_spent"), strict) if defaults else \
        F.when(_p("total_spent").isNotNull(), X.money(_p("total_spent"), strict))
    return df.select(
        _store(df).alias("store_id"),
        _p("id").cast("string").alias("customer_id"),
        _p("email").alias("email"),
        _p("first_name").alias("first_name"),
        _p("last_name").alias("last_name"),
        d(_p("orders_count"), 0).alias("orders_count"),
        spent.alias("total_spent"),
        d(_p("state"), DEFAULT_CUSTOMER_STATE).alias("customer_state"),
        marketing.alias("accepts_marketing"),
        X.id_text(_p("last_order_id")).alias("last_order_id"),
        _p("note").alias("note"),
        d(_p("verified_email"), False).alias("verified_email"),
        d(_p("tax_exempt"), False).alias("tax_exempt"),
        (X.tags_json(_p("tags")) if defaults else
         F.when(_p("tags").isNotNull(), X.tags_json(_p("tags")))).alias("tags"),
        d(_p("currency"), DEFAULT_CURRENCY).alias("currency"),
        _p("default_address.country").alias("country"),
        _p("default_address.province").alias("province"),
        _p("default_address.city").alias("city"),
        _p("default_address.zip").alias("zip"),
        X.iso_utc(_p("created_at")).alias("created_at"),
        X.iso_utc(_p("updated_at")).alias("updated_at"),
        *_arrival(df),
    )


def flatten_orders(df: DataFrame, strict: bool = True) -> DataFrame:
    """Order payload -> orders row.

    customer_id comes from the nested customer object (NULL for guests);
    total_items is the number of line-item entries (not units), 0 when the
    list is empty or absent; order_number falls back to the display name.
    An order whose items take several payloads is the row of the first one,
    which states the count; the others are for ``explode_line_items`` only."""
    if "p" in df.columns:
        df = df.filter(F.coalesce(_p("line_page"), F.lit(0)) == 0)
    else:
        # told from the text: a filter on the parsed record is pushed below the parse and parses every record again
        df = parse(df.filter(~F.coalesce(F.col("payload").rlike(LATER_PAGE), F.lit(False))), ORDER_PAYLOAD)
    created = X.iso_utc(_p("created_at"))
    return df.select(
        _store(df).alias("store_id"),
        _p("id").cast("string").alias("order_id"),
        X.id_text(_p("customer.id")).alias("customer_id"),
        F.coalesce(_p("order_number").cast("string"), _p("name")).alias("order_number"),
        X.money(_p("total_price"), strict).alias("total_price"),
        X.money(_p("subtotal_price"), strict).alias("subtotal_price"),
        X.money(_p("total_tax"), strict).alias("total_tax"),
        X.money(_p("total_discounts"), strict).alias("total_discounts"),
        F.coalesce(_p("currency"), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        _p("financial_status").alias("financial_status"),
        _p("fulfillment_status").alias("fulfillment_status"),
        _p("processing_method").alias("processing_method"),
        _p("source_name").alias("source_name"),
        _p("gateway").alias("gateway"),
        F.coalesce(_p("test"), F.lit(False)).alias("test"),
        F.coalesce(_p("taxes_included"), F.lit(False)).alias("taxes_included"),
        F.coalesce(_p("total_weight"), F.lit(0.0)).alias("total_weight"),
        F.coalesce(_p("line_items_count").cast("int"), F.size(_p("line_items")), F.lit(0)).alias("total_items"),
        _p("tags").alias("tags"),
        _p("shipping_address.name").alias("shipping_name"),
        _p("shipping_address.address1").alias("shipping_address1"),
        _p("shipping_address.city").alias("shipping_city"),
        _p("shipping_address.province").alias("shipping_province"),
        _p("shipping_address.country").alias("shipping_country"),
        _p("shipping_address.zip").alias("shipping_zip"),
        created.alias("order_date"),
        created.alias("created_at"),
        X.iso_utc(_p("updated_at")).alias("updated_at"),
        X.iso_utc(_p("cancelled_at")).alias("cancelled_at"),
        X.iso_utc(_p("closed_at")).alias("closed_at"),
        X.iso_utc(_p("processed_at")).alias("processed_at"),
        _p("cancel_reason").alias("cancel_reason"),
        *_arrival(df),
    )


# Order fields an item row reads.  The parsed struct is carried through the
# explode, where the optimizer cannot prune the JSON schema, so the item
# flatten parses only these.  from_json keeps partial results, so a bad
# value in another field changes nothing here (tested).
ITEM_ORDER_FIELDS = ("id", "created_at", "line_items")


def line_items(df: DataFrame, where: Column | None = None) -> DataFrame:
    """One row per line item as a struct ``li``, with store, order id and the
    order's created_at (P3).  Inner explode: an order without items yields no row,
    nor does one for which ``where`` does not hold."""
    df = parse(df, T.StructType([ORDER_PAYLOAD[f] for f in ITEM_ORDER_FIELDS]))
    # explode_outer + filter instead of explode: for a plain explode the
    # optimizer infers "size(line_items) > 0" and pushes it below the parse,
    # which evaluates the JSON parse a second time inside that filter.
    extra = [c for c in ("page", "ingest_seq") if c in df.columns]
    return df.select(_store(df).alias("store_id"),
                     _p("id").cast("string").alias("order_id"),
                     X.iso_utc(_p("created_at")).alias("created_at"), *extra,
                     F.explode_outer(_p("line_items") if where is None else F.when(where, _p("line_items"))).alias("li")) \
        .filter(F.col("li").isNotNull())


def explode_line_items(df: DataFrame, strict: bool = True) -> DataFrame:
    """One row per line item, inheriting the order id and the order's created_at."""
    return flatten_items(line_items(df), strict)


def flatten_items(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of ``line_items`` -> order_items rows."""
    li = lambda f: F.col(f"li.{f}")
    return lines.select(
        "store_id",
        li("id").cast("string").alias("order_item_id"),
        "order_id",
        X.id_text(li("product_id")).alias("product_id"),
        X.id_text(li("variant_id")).alias("variant_id"),
        li("title").alias("title"),
        li("name").alias("name"),
        F.coalesce(li("quantity"), F.lit(0)).alias("quantity"),
        X.money(li("price"), strict).alias("price"),
        li("sku").alias("sku"),
        li("vendor").alias("vendor"),
        F.coalesce(li("requires_shipping"), F.lit(False)).alias("requires_shipping"),
        F.coalesce(li("taxable"), F.lit(True)).alias("taxable"),
        F.coalesce(li("gift_card"), F.lit(False)).alias("gift_card"),
        li("fulfillable_quantity").alias("fulfillable_quantity"),
        li("fulfillment_status").alias("fulfillment_status"),
        F.coalesce(li("grams"), F.lit(0)).alias("grams"),
        X.money(li("total_discount"), strict).alias("total_discount"),
        "created_at",
        *_arrival(lines),
    )


def flatten_checkouts(df: DataFrame, strict: bool = True) -> DataFrame:
    """Checkout payload -> abandoned_checkouts row; abandoned_at := created_at."""
    df = parse(df, CHECKOUT_PAYLOAD)
    created = X.iso_utc(_p("created_at"))
    return df.select(
        _store(df).alias("store_id"),
        _p("id").cast("string").alias("checkout_id"),
        X.id_text(_p("customer.id")).alias("customer_id"),
        _p("email").alias("email"),
        X.money(_p("total_price"), strict).alias("total_price"),
        X.money(_p("subtotal_price"), strict).alias("subtotal_price"),
        X.money(_p("total_tax"), strict).alias("total_tax"),
        X.money(_p("total_discounts"), strict).alias("total_discounts"),
        F.coalesce(_p("currency"), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        X.iso_utc(_p("completed_at")).alias("completed_at"),
        created.alias("created_at"),
        X.iso_utc(_p("updated_at")).alias("updated_at"),
        created.alias("abandoned_at"),
        _p("recovery_url").alias("recovery_url"),
        *_arrival(df),
    )


def flatten_refunds(df: DataFrame, strict: bool = True) -> DataFrame:
    """Refund payload -> refunds row."""
    df = parse(df, REFUND_PAYLOAD)
    return df.select(
        _store(df).alias("store_id"),
        _p("id").cast("string").alias("refund_id"),
        _p("order_id").cast("string").alias("order_id"),
        X.id_text(_p("customer.id")).alias("customer_id"),
        _p("status").alias("status"),
        X.money(_p("amount"), strict).alias("amount"),
        F.coalesce(_p("currency"), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        _p("reason").alias("reason"),
        _p("note").alias("note"),
        F.coalesce(_p("restock"), F.lit(False)).alias("restock_items"),
        X.iso_utc(_p("created_at")).alias("created_at"),
        X.iso_utc(_p("processed_at")).alias("processed_at"),
        *_arrival(df),
    )


def abandoned_only(checkouts: DataFrame) -> DataFrame:
    """Keep checkouts never completed (F1)."""
    return checkouts.filter(F.col("completed_at").isNull())


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """Lower-case column names and keep only the target's columns.
    Schema metadata only; no data is touched."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    keep = [f.name for f in target.fields if f.name in lowered.columns]
    return lowered.select(*[F.col(c).cast(target[c].dataType).alias(c) for c in keep])


def stamp(df: DataFrame, as_of, columns=("ingestion_timestamp",)) -> DataFrame:
    """Audit stamps: one value per job run, never per row."""
    for c in columns:
        df = df.withColumn(c, X.ts_lit(as_of))
    return df


def as_text_columns(df: DataFrame) -> DataFrame:
    """Timestamp columns as text, for text-only sinks."""
    return df.select(*[
        F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
        for f in df.schema.fields])
