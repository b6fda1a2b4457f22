"""Streaming = batch, replay is a no-op, and T2 refresh."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lifetide.sources import payloads as PL
from lifetide.sources.bridge import Bridge
from lifetide.streaming import changes as C

from conftest import SF_SMALL

AS_OF = "2001-08-02 00:00:00"


def land(spark, src_dir):
    """Land change events from the sf0.001 tables: customers first, then orders."""
    b = Bridge(spark, SF_SMALL)
    cust = PL.customer_payloads(b).select(
        F.concat(F.lit('{"store_id":"'), "store_id", F.lit('","customer":'), "payload", F.lit("}")).alias("value"))
    orders = PL.order_payloads(b).select(
        F.concat(F.lit('{"store_id":"'), "store_id", F.lit('","order":'), "payload", F.lit("}")).alias("value"))
    cust.coalesce(1).write.text(os.path.join(src_dir, "batch1"))
    orders.coalesce(1).write.text(os.path.join(src_dir, "batch2"))


def snapshot(spark, tables, name):
    df = spark.read.parquet(tables.path(name))
    return sorted(tuple(str(v) for v in r) for r in df.drop("ingestion_timestamp").collect())


def test_stream_equals_batch_and_replay_is_noop(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    land(spark, src)
    files = [os.path.join(src, d) for d in ("batch1", "batch2")]

    streamed = C.Tables(os.path.join(tmp_dir, "stream"))
    ck = os.path.join(tmp_dir, "ck")
    # one micro-batch per landed file: customers, then orders
    q = (spark.readStream.schema(C.CHANGE_EVENT).option("maxFilesPerTrigger", 1).json(src + "/*")
         .writeStream.foreachBatch(lambda df, _id: C.apply_batch(df, streamed, AS_OF))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(600)

    batched = C.Tables(os.path.join(tmp_dir, "batch"))
    for f in files:
        C.apply_batch(spark.read.schema(C.CHANGE_EVENT).json(f), batched, AS_OF)

    for name in ("customers", "orders", "order_items"):
        assert snapshot(spark, streamed, name) == snapshot(spark, batched, name), name

    before = snapshot(spark, batched, "customers")
    C.apply_batch(spark.read.schema(C.CHANGE_EVENT).json(files[1]), batched, AS_OF)
    assert snapshot(spark, batched, "customers") == before

    # restarting on the same checkpoint finds nothing new
    q2 = C.start(spark, src + "/*", streamed, ck, AS_OF)
    q2.awaitTermination(600)
    assert snapshot(spark, streamed, "orders") == snapshot(spark, batched, "orders")


def test_refresh_sets_status_from_orders(spark, tmp_dir):
    tables = C.Tables(tmp_dir)
    ev = spark.createDataFrame(
        [('{"store_id":"s1","customer":{"id":1,"email":"a@x"}}',),
         ('{"store_id":"s1","order":{"id":10,"customer":{"id":1},"total_price":"40.00",'
          '"created_at":"2001-07-30T00:00:00Z","line_items":[{"id":100,"quantity":1,"price":"40.00"}]}}',)],
        "value string")
    parsed = ev.select(F.from_json("value", C.CHANGE_EVENT).alias("e")).select("e.*")
    C.apply_batch(parsed, tables, AS_OF)
    c = spark.read.parquet(tables.path("customers")).first()
    assert (c.status, c.orders_count, float(c.total_spent), c.email) == ("active", 1, 40.0, "a@x")
    assert c.last_order_date == dt.datetime(2001, 7, 30)
    assert spark.read.parquet(tables.path("order_items")).count() == 1


def test_watermark_dedup_drops_redeliveries(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    line = ('{"store_id":"s1","order":{"id":%d,"customer":{"id":1},"total_price":"1.00",'
            '"created_at":"2001-07-30T00:00:00Z","updated_at":"2001-07-30T00:00:00Z"}}')
    spark.createDataFrame([(line % 1,), (line % 1,), (line % 2,)], "value string") \
        .coalesce(1).write.text(os.path.join(src, "b1"))
    seen = []
    q = (C.dedupe_within(C.read_changes(spark, src + "/*"), "1 hour").writeStream
         .foreachBatch(lambda df, _id: seen.extend(r.order.id for r in df.collect()))
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted(seen) == [1, 2]


def events(spark, *lines):
    schema = C.CHANGE_EVENT
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return df.select(F.from_json("value", schema).alias("e")).select("e.*")


def order(oid, price, *items, created="2001-07-30T00:00:00Z"):
    import json
    return json.dumps({"store_id": "s1", "order": {"id": oid, "customer": {"id": 1}, "total_price": price, "created_at": created,
                                                   "line_items": [{"id": i, "price": "1.00"} if i else {"price": "1.00"} for i in items]}})


CUSTOMER = '{"store_id":"s1","customer":{"id":1,"email":"a@x"}}'


def test_stored_order_stays_as_it_is(spark, tmp_dir):
    """An order that comes again with another price and another item changes nothing (K5)."""
    tables = C.Tables(tmp_dir)
    C.apply_batch(events(spark, CUSTOMER, order(10, "40.00", 100)), tables, AS_OF)
    C.apply_batch(events(spark, order(10, "99.00", 100, 200), order(11, "2.00", 300)), tables, AS_OF)
    orders = {r.order_id: float(r.total_price) for r in spark.read.parquet(tables.path("orders")).collect()}
    assert orders == {"10": 40.0, "11": 2.0}
    assert sorted(r.order_item_id for r in spark.read.parquet(tables.path("order_items")).collect()) == ["100", "300"]
    c = spark.read.parquet(tables.path("customers")).first()
    assert (c.orders_count, float(c.total_spent), c.clv_prediction) == (2, 42.0, None)


def test_replay_changes_nothing(spark, tmp_dir):
    """The same batch again, whole or after a failure before the orders were stored; items without id are set aside once stored ones stay."""
    tables = C.Tables(tmp_dir)
    batch = events(spark, CUSTOMER, order(10, "40.00", 100, None))
    real = C.U.append

    def failing(df, path, name):
        if name == "orders":
            raise RuntimeError("lost")
        return real(df, path, name)
    C.U.append = failing
    try:
        try:
            C.apply_batch(batch, tables, AS_OF, batch_id=7)
        except RuntimeError:
            pass
    finally:
        C.U.append = real
    for _ in range(2):
        C.apply_batch(batch, tables, AS_OF, batch_id=7)
    c = spark.read.parquet(tables.path("customers")).first()
    assert (c.orders_count, float(c.total_spent), c.status) == (1, 40.0, "active")
    assert spark.read.parquet(tables.path("order_items")).count() == 1
    assert spark.read.parquet(tables.path("orders")).count() == 1


def test_bad_events_are_set_aside(spark, tmp_dir):
    """An unreadable line and a bad amount neither vanish nor stop the stream."""
    src, tables = os.path.join(tmp_dir, "in"), C.Tables(os.path.join(tmp_dir, "t"))
    spark.createDataFrame([(CUSTOMER,), ("{broken",), (order(10, "n/a"),), (order(11, "5.00"),)], "value string").coalesce(1).write.text(os.path.join(src, "b"))
    C.start(spark, src + "/*", tables, os.path.join(tmp_dir, "ck")).awaitTermination(300)
    aside = sorted((r.resource, r.problem) for r in spark.read.parquet(tables.path("quarantine")).collect())
    assert aside == [("events", "unreadable"), ("orders", "total_price")]
    assert [r.order_id for r in spark.read.parquet(tables.path("orders")).collect()] == ["11"]
    assert spark.read.parquet(tables.path("customers")).count() == 1
