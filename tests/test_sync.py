"""Landed pages (S1) -> ordered sync (K8) with quarantine (K9), stamps (P12),
appends (K1, K2), cursors (S2, A14), NULL-key joins and catalog checks (F5)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lifetide.operators import flatten as P
from lifetide.operators import quality as Q
from lifetide.operators import upsert as U
from lifetide.operators.joins import left_join_nullsafe
from lifetide.plans.sync import sync_all
from lifetide.sources import incremental as I
from lifetide.sources.landed import land_pages, read_pages
from lifetide.streaming.changes import Tables

AS_OF = "2024-06-01 00:00:00"


def pages(spark, rows):
    return spark.createDataFrame([(s, json.dumps(p) if isinstance(p, dict) else p) for s, p in rows],
                                 "store_id string, payload string")


def test_landed_pages_sync_in_order(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    land_pages(pages(spark, [("s1", {"id": 1, "email": "a@x", "updated_at": "2024-01-01T00:00:00Z"}),
                             ("s1", {"id": 1, "email": "a2@x", "updated_at": "2024-02-01T00:00:00Z"}),
                             ("s2", {"id": 1, "email": "b@x"})]), landing, "customers")
    land_pages(pages(spark, [("s1", {"id": 10, "customer": {"id": 1}, "total_price": "5.00",
                                     "created_at": "2024-01-05T00:00:00Z",
                                     "line_items": [{"id": 100, "quantity": 1}, {"id": 101}]}),
                             ("s1", {"id": 11, "total_price": "junk"}),
                             ("s2", "{broken")]), landing, "orders")
    land_pages(pages(spark, [("s1", {"id": 7, "created_at": "2024-01-01T00:00:00Z", "total_price": "3"}),
                             ("s1", {"id": 8, "created_at": "2024-01-01T00:00:00Z",
                                     "completed_at": "2024-01-01T00:10:00Z"})]), landing, "abandoned_checkouts")
    assert read_pages(spark, landing, "customers").count() == 3

    tables = Tables(f"{tmp_dir}/tables")
    summary = {(r.table_name, r.store_id): (r.rows_loaded, r.rows_quarantined, r.success)
               for r in sync_all(spark, landing, tables, AS_OF).collect()}
    assert summary[("customers", "s1")] == (2, 0, True)
    assert summary[("orders", "s1")] == (1, 1, False) and summary[("orders", "s2")] == (0, 1, False)
    cust = {(r.store_id, r.customer_id): r.email for r in spark.read.parquet(tables.path("customers")).collect()}
    assert cust == {("s1", "1"): "a2@x", ("s2", "1"): "b@x"}  # latest per key, per store
    assert spark.read.parquet(tables.path("order_items")).count() == 2
    ck = [r.checkout_id for r in spark.read.parquet(tables.path("abandoned_checkouts")).collect()]
    assert ck == ["7"]  # the completed checkout is not abandoned
    stamps = spark.read.parquet(tables.path("orders")).select("ingestion_timestamp").distinct().collect()
    assert [r[0] for r in stamps] == [dt.datetime(2024, 6, 1)]  # one value per run (P12)


def test_sync_applies_customers_then_stops_at_missing_orders(spark, tmp_dir):
    # K8: resources apply in order and the first failing one stops the sync;
    # with no order pages landed, customers are already stored when it stops
    import pytest
    landing = f"{tmp_dir}/landing"
    land_pages(pages(spark, [("s1", {"id": 1, "email": "a@x"})]), landing, "customers")
    tables = Tables(f"{tmp_dir}/tables")
    with pytest.raises(Exception):
        sync_all(spark, landing, tables, AS_OF)
    assert [r.customer_id for r in spark.read.parquet(tables.path("customers")).collect()] == ["1"]
    assert not U.table_exists(spark, tables.path("orders"))


def test_append_keeps_the_layout(spark, tmp_dir):
    """Append into a created table, then an upsert, then a read: one layout (K1, K2, K3)."""
    path = f"{tmp_dir}/o"
    U.create_table(spark, path, "orders")
    df = spark.createDataFrame([("s1", "1"), ("s2", "2")], "store_id string, order_id string")
    U.append(df, path, "orders")
    U.append(df, path, "orders")
    assert spark.read.parquet(path).count() == 4  # append really appends (K1)
    U.upsert_table(spark, path, "orders", df.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp_ntz")))
    assert sorted(r.order_id for r in U.read_or_empty(spark, path, "orders").collect()) == ["1", "1", "2", "2"]
    U.rebucket(spark, path, "orders", 2)
    assert U.table_buckets(spark, path) == 2 and U.read_or_empty(spark, path, "orders").count() >= 2


def landed(spark, landing, **resources):
    for name, rows in resources.items():
        land_pages(pages(spark, rows), landing, name)


def test_bad_values_stop_nothing_and_are_kept(spark, tmp_dir):
    """A bad amount or time in any resource goes to quarantine; every other row of every store is stored."""
    landing, tables = f"{tmp_dir}/landing", Tables(f"{tmp_dir}/tables")
    t = "2024-05-01T00:00:00Z"
    landed(spark, landing,
           customers=[("s1", {"id": 1, "total_spent": "n/a"}), ("s2", {"id": 1, "email": "ok@x"})],
           orders=[("s1", {"id": 10, "created_at": t, "customer": {"id": 1}, "total_price": "3", "line_items": [{"id": 1, "price": "n/a"}, {"id": 2, "price": "1"}, {"price": "5"}]}),
                   ("s2", {"id": 10, "created_at": t, "customer": {"id": 1}, "total_price": "40.00", "line_items": [{"id": 1}, {"id": 2}, {"id": 3}]}),
                   ("s2", {"id": 11, "updated_at": "soon"}), ("s2", "{broken")],
           abandoned_checkouts=[("s1", {"id": 8, "completed_at": "not a time"}), ("s1", {"id": 9, "created_at": t}),
                                ("s1", {"id": 7, "created_at": t, "completed_at": t})],
           refunds=[("s2", {"id": 5, "order_id": 10, "amount": "4.00", "created_at": t}), ("s2", {"id": 6, "order_id": 10, "amount": "x"})])
    summary = {(r.table_name, r.store_id): (r.rows_loaded, r.rows_quarantined) for r in sync_all(spark, landing, tables, AS_OF).collect()}
    assert summary[("order_items", "s1")] == (1, 2) and summary[("order_items", "s2")] == (3, 0)
    assert summary[("orders", "s2")] == (1, 2) and summary[("customers", "s1")] == (0, 1)
    assert summary[("abandoned_checkouts", "s1")] == (1, 1) and summary[("refunds", "s2")] == (1, 1)
    aside = {(r.resource, r.store_id, r.problem) for r in spark.read.parquet(tables.path("quarantine")).collect()}
    assert aside == {("customers", "s1", "total_spent"), ("orders", "s2", "updated_at"), ("orders", "s2", "unreadable"), ("order_items", "s1", "price"),
                     ("order_items", "s1", "id"), ("abandoned_checkouts", "s1", "completed_at"), ("refunds", "s2", "amount")}
    # the roll-up and the stored metrics follow the sync (A7, A8, A11); the prediction column stays empty
    c = [r for r in spark.read.parquet(tables.path("customers")).collect() if r.store_id == "s2"][0]
    assert (c.orders_count, float(c.total_spent), c.status, c.clv_prediction) == (1, 40.0, "active", None)
    m = [r for r in spark.read.parquet(tables.path("customer_metrics")).collect() if r.store_id == "s2"][0]
    assert (m.total_orders, m.refunds_count, m.total_refunded, m.refund_rate) == (1, 1, 4.0, 0.1)


def test_order_of_many_items_is_one_row(spark, tmp_dir):
    """900 items of one order, over several payloads: one order with 900, and 900 items."""
    import shutil

    from lifetide.plans.catalog import get_queries
    base = f"{tmp_dir}/data"
    # contents only: the given files cannot be written or removed, nor can copies that keep their modes
    shutil.os.mkdir(base)
    for name in shutil.os.listdir("/root/testdata/sf0.001"):
        if name != "lineitem.parquet" and shutil.os.path.isfile(f"/root/testdata/sf0.001/{name}"):
            shutil.copyfile(f"/root/testdata/sf0.001/{name}", f"{base}/{name}")
    orders, li = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("orders", "lineitem"))
    key = orders.agg(F.max("o_orderkey")).first()[0]
    line = li.limit(1).withColumn("l_orderkey", F.lit(key).cast(li.schema["l_orderkey"].dataType))
    many = line.crossJoin(spark.range(900)).withColumn("l_linenumber", (F.col("id") + 1).cast(li.schema["l_linenumber"].dataType)).drop("id")
    li.filter(F.col("l_orderkey") != key).unionByName(many).write.parquet(f"{tmp_dir}/li")
    shutil.copytree(f"{tmp_dir}/li", f"{base}/lineitem.parquet")
    flat = get_queries()["flatten_orders"](spark, base)
    assert flat.count() == orders.count()
    assert [r.total_items for r in flat.filter(F.col("order_id") == str(key)).collect()] == [900]
    assert get_queries()["explode_line_items"](spark, base).filter(F.col("order_id") == str(key)).count() == 900


def test_later_arrival_wins_a_tie(spark, tmp_dir):
    landing, tables = f"{tmp_dir}/landing", Tables(f"{tmp_dir}/tables")
    t = "2024-01-01T00:00:00Z"
    landed(spark, landing, customers=[("s1", {"id": 1, "email": "z@x", "updated_at": t}), ("s1", {"id": 1, "email": "a@x", "updated_at": t})],
           orders=[("s1", {"id": 1})], abandoned_checkouts=[("s1", {"id": 1})])
    sync_all(spark, landing, tables, AS_OF)
    assert [r.email for r in spark.read.parquet(tables.path("customers")).collect()] == ["a@x"]


def test_arrival_mode(spark, tmp_dir):
    rows = spark.createDataFrame([("s", "1", "2024-02-01", 1), ("s", "1", "2024-01-01", 2)], "store_id string, order_id string, updated_at string, seq int") \
        .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    U.upsert_table(spark, f"{tmp_dir}/o", "orders", rows, mode="arrival", seq="seq")
    assert spark.read.parquet(f"{tmp_dir}/o").first().updated_at == dt.datetime(2024, 1, 1)


def test_unknown_store_refuses_the_sync(spark, tmp_dir):
    import pytest

    from lifetide.plans.sync import UnknownStore
    registry = spark.createDataFrame([("s1",)], "store_id string")
    with pytest.raises(UnknownStore, match="s9"):
        sync_all(spark, f"{tmp_dir}/none", Tables(f"{tmp_dir}/t"), AS_OF, stores=["s1", "s9"], registry=registry)


def test_insert_rewrites_no_file_and_leaves_nothing_staged(spark, tmp_dir):
    import glob
    import os

    from lifetide.session import checkpoint_dir
    path = f"{tmp_dir}/o"
    rows = lambda lo, hi: spark.range(lo, hi).select(F.lit("s").alias("store_id"), F.col("id").cast("string").alias("order_id"),
                                                     F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"))
    U.upsert_table(spark, path, "orders", rows(0, 500), mode="insert")
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}
    U.upsert_table(spark, path, "orders", rows(400, 1400), mode="insert")
    assert all(os.path.getmtime(f) == m for f, m in before.items())
    assert spark.read.parquet(path).count() == 1400
    U.upsert_table(spark, path, "orders", rows(400, 1400), mode="insert")
    assert spark.read.parquet(path).count() == 1400
    folder = checkpoint_dir(spark).removeprefix("file:")
    assert not glob.glob(f"{folder}/staged-*")


def test_marks_are_kept(spark, tmp_dir):
    df = spark.createDataFrame([("s1", "5"), ("s1", "12"), ("s2", "3")], "store_id string, id string")
    assert I.read_new(df, tmp_dir, "orders", "id").count() == 3
    I.mark_read(df, tmp_dir, "orders", "id")
    more = df.union(spark.createDataFrame([("s2", "9")], "store_id string, id string"))
    assert [r.id for r in I.read_new(more, tmp_dir, "orders", "id").collect()] == ["9"]
    I.mark_read(more, tmp_dir, "orders", "id")
    assert I.read_new(more, tmp_dir, "orders", "id").count() == 0


def test_tables_see_files_added_later(spark, tmp_dir):
    from lifetide.sources.tables import read_table
    spark.range(5).write.parquet(f"{tmp_dir}/t.parquet")
    assert read_table(spark, tmp_dir, "t").count() == 5
    spark.range(5).write.mode("append").parquet(f"{tmp_dir}/t.parquet")
    assert read_table(spark, tmp_dir, "t").count() == 10


def test_catalog_tables_and_returns_view(spark, tmp_dir):
    from lifetide.plans.sync import create_catalog
    from lifetide.schemas import TABLES
    create_catalog(spark, Tables(f"{tmp_dir}/tables"), "lifetide_test")
    try:
        got = {r.table_name: r.present for r in Q.tables_present(spark, [*TABLES, "returns", "nothing"], "lifetide_test").collect()}
        assert got == {**{t: True for t in TABLES}, "returns": True, "nothing": False}
        assert "refund_amount" in spark.table("lifetide_test.returns").columns
    finally:
        spark.sql("DROP DATABASE lifetide_test CASCADE")


def test_cursor_marks_advance(spark):
    df = spark.createDataFrame([("s1", "5"), ("s1", "12"), ("s2", "3"), ("s3", "1")], "store_id string, id string")
    marks = spark.createDataFrame([("s1", 10), ("s2", 3)], "store_id string, since_id long")
    batch = I.since(df, "id", marks)
    assert sorted((r.store_id, r.id) for r in batch.collect()) == [("s1", "12"), ("s3", "1")]
    new = {r.store_id: r.since_id for r in I.advance(marks, batch, "id").collect()}
    assert new == {"s1": 12, "s2": 3, "s3": 1}
    assert [r.id for r in I.since(df, "id", 4).collect()] == ["5", "12"]


def test_left_join_nullsafe_keeps_guests(spark):
    left = spark.createDataFrame([("c1", 1), (None, 2)], "customer_id string, v int")
    right = spark.createDataFrame([("c1", "Ann")], "customer_id string, name string")
    got = sorted((r.v, r.name) for r in left_join_nullsafe(left, right, ["customer_id"]).collect())
    assert got == [(1, "Ann"), (2, None)]


def test_catalog_membership(spark):
    spark.range(1).createOrReplaceTempView("orders_chk")
    got = {r.table_name: r.present for r in Q.tables_present(spark, ["ORDERS_CHK", "refunds_chk"]).collect()}
    assert got == {"orders_chk": True, "refunds_chk": False}
