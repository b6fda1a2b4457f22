"""Roll-ups by differences: streams, replays, changed orders and syncs give the totals of a full recompute."""

import itertools
import json
import os
import random

import pytest

from pyspark.sql import functions as F

from lifetide.operators import metrics as M
from lifetide.operators import publish as PB
from lifetide.operators import upsert as U
from lifetide.plans.sync import customer_metrics_rows, rebuild_rollups, status_of, sync_all
from lifetide.sources.landed import land_pages
from lifetide.streaming import changes as C

AS_OF = "2001-08-02 00:00:00"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Tiny tables in many jobs: little to shuffle, and compiling plans would take most of the time."""
    conf = {"spark.sql.shuffle.partitions": "2", "lifetide.upsert.buckets": "2", "spark.sql.codegen.wholeStage": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def day(n):
    return f"2001-{1 + n // 28:02d}-{1 + n % 28:02d}T00:00:00Z"


def event(spark, path, *parts):
    spark.createDataFrame([(json.dumps({"store_id": "s1", **p}),) for p in parts], "value string").coalesce(1).write.mode("append").text(path)


def customer(cid):
    return {"customer": {"id": cid, "email": f"{cid}@x", "orders_count": 77, "total_spent": "7.00"}}


def order(oid, cid, price, when=0):
    return {"order": {"id": oid, "customer": {"id": cid} if cid else None, "total_price": price, "created_at": day(when), "updated_at": day(when)}}


def assert_like_recompute(spark, tables):
    """Stored customers and metrics against a recompute from the stored orders, checkouts and refunds."""
    read = lambda n: U.read_or_empty(spark, tables.path(n), n)
    profile = {(r.store_id, r.customer_id): r for r in customer_metrics_rows(
        M.clv_profile(read("customers"), read("orders"), read("abandoned_checkouts"), read("refunds")), AS_OF).collect()}
    metrics = {(r.store_id, r.customer_id): r for r in read("customer_metrics").collect()}
    customers = {(r.store_id, r.customer_id): r for r in read("customers").collect()}
    assert set(metrics) == set(profile) == set(customers)
    for k, want in profile.items():
        got = metrics[k]
        for c in ("total_orders", "total_spent", "average_order_value", "first_order_date", "last_order_date", "abandoned_checkouts_count",
                  "refunds_count", "total_refunded", "refund_rate"):
            assert getattr(got, c) == getattr(want, c), (k, c, getattr(got, c), getattr(want, c))
        c = customers[k]
        if want.total_orders:
            assert (c.orders_count, float(c.total_spent), c.first_order_date, c.last_order_date) == (
                want.total_orders, want.total_spent, want.first_order_date, want.last_order_date)
            assert c.status in ("active", "inactive")
    return customers


def run_stream(spark, src, tables, checkpoint):
    C.start(spark, src + "/*", tables, checkpoint, AS_OF).awaitTermination(600)


def test_two_streams_and_a_reset_checkpoint(spark, tmp_dir):
    """Two streams write into the same tables; the second's checkpoint is lost and everything comes again."""
    tables = C.Tables(f"{tmp_dir}/t")
    event(spark, f"{tmp_dir}/a/1", customer(1), order(10, 1, "40.00", 200))
    event(spark, f"{tmp_dir}/b/1", order(11, 1, "60.00", 210), order(12, 2, "5.00", 3), {"order": {"id": 13, "total_price": "n/a"}})
    run_stream(spark, f"{tmp_dir}/a", tables, f"{tmp_dir}/ck-a")
    run_stream(spark, f"{tmp_dir}/b", tables, f"{tmp_dir}/ck-b")
    c = assert_like_recompute(spark, tables)[("s1", "1")]
    assert (c.orders_count, float(c.total_spent), c.status) == (2, 100.0, "active")
    run_stream(spark, f"{tmp_dir}/b", tables, f"{tmp_dir}/ck-lost")
    event(spark, f"{tmp_dir}/a/2", customer(2), order(14, 1, "1.00", 1))
    run_stream(spark, f"{tmp_dir}/a", tables, f"{tmp_dir}/ck-a")
    found = assert_like_recompute(spark, tables)
    assert (found["s1", "1"].orders_count, float(found["s1", "1"].total_spent)) == (3, 101.0)
    # the order came before its customer; the shop's own count does not replace the roll-up
    assert (found["s1", "2"].orders_count, float(found["s1", "2"].total_spent)) == (1, 5.0)
    ids = {r.run_id.rsplit("-", 1)[0] for r in spark.read.parquet(tables.path("quarantine")).collect()}
    assert ids == {C.stream_id(spark, f"{tmp_dir}/ck-b"), C.stream_id(spark, f"{tmp_dir}/ck-lost")}
    assert not os.listdir(f"{tables.root}/_staged")


@pytest.mark.parametrize("lost_after", [2])
def test_a_batch_that_fails_anywhere(spark, tmp_dir, monkeypatch, lost_after):
    """After a failure at any write, another writer comes first, then the batch again: the tables of a clean run, nothing twice."""
    tables = C.Tables(f"{tmp_dir}/t")
    batch = lambda *parts: spark.createDataFrame([(json.dumps({"store_id": "s1", **p}),) for p in parts], "value string").select(
        F.from_json("value", C.CHANGE_EVENT).alias("e")).select("e.*")
    first = batch(customer(1), order(10, 1, "40.00", 5), {"order": {"id": 9, "total_price": "n/a"}})
    calls = itertools.count()
    real = U.upsert_table

    def failing(*args, **kw):
        if next(calls) == lost_after:
            raise RuntimeError("lost")
        return real(*args, **kw)
    monkeypatch.setattr(U, "upsert_table", failing)
    try:
        C.apply_batch(first, tables, AS_OF, 0, "one")
    except RuntimeError:
        pass
    monkeypatch.setattr(U, "upsert_table", real)
    C.apply_batch(batch(order(11, 1, "2.00", 6)), tables, AS_OF, 0, "two")
    C.apply_batch(first, tables, AS_OF, 0, "one")
    c = assert_like_recompute(spark, tables)[("s1", "1")]
    assert (c.orders_count, float(c.total_spent)) == (2, 42.0)
    assert spark.read.parquet(tables.path("quarantine")).count() == 1


def land(spark, landing, **resources):
    for name, rows in resources.items():
        land_pages(spark.createDataFrame([(s, json.dumps(p)) for s, p in rows], "store_id string, payload string"), landing, name)


def test_changed_and_moved_orders(spark, tmp_dir):
    """Random syncs: new prices and dates, orders that change customers, refunds before and after their orders, repeated pages."""
    rnd = random.Random(7)
    landing, tables = f"{tmp_dir}/landing", C.Tables(f"{tmp_dir}/t")
    for sync in range(3):
        land(spark, landing,
             customers=[(f"s{rnd.randrange(2)}", {"id": rnd.randrange(6), "email": "x", "orders_count": 50, "updated_at": day(sync)}) for _ in range(3)],
             orders=[(f"s{rnd.randrange(2)}", {"id": rnd.randrange(12), "customer": {"id": rnd.randrange(6)} if rnd.random() < 0.9 else None,
                                               "total_price": f"{rnd.randrange(100)}.50", "created_at": day(rnd.randrange(300)), "updated_at": day(sync)}) for _ in range(9)],
             abandoned_checkouts=[(f"s{rnd.randrange(2)}", {"id": rnd.randrange(9), "customer": {"id": rnd.randrange(6)}, "created_at": day(sync)}) for _ in range(4)],
             refunds=[(f"s{rnd.randrange(2)}", {"id": rnd.randrange(9), "order_id": rnd.randrange(12), "amount": f"{rnd.randrange(9)}.25", "created_at": day(sync)}) for _ in range(4)])
        sync_all(spark, landing, tables, f"2001-08-0{sync + 2} 00:00:00")
        assert_like_recompute(spark, tables)
    before = sorted(map(str, U.read_or_empty(spark, tables.path("customer_rollups"), "customer_rollups").drop("updated_at", "key_bucket").collect()))
    rebuild_rollups(spark, tables, AS_OF)
    after = sorted(map(str, U.read_or_empty(spark, tables.path("customer_rollups"), "customer_rollups").drop("updated_at", "key_bucket").collect()))
    assert before == after
    assert_like_recompute(spark, tables)


def test_orders_are_not_read_again(spark, tmp_dir, monkeypatch):
    """A sync of a few orders reads the whole order table only if a first or last order left."""
    from lifetide.operators import rollups as R
    landing, tables = f"{tmp_dir}/landing", C.Tables(f"{tmp_dir}/t")
    land(spark, landing, customers=[("s1", {"id": i}) for i in range(1, 6)],
         orders=[("s1", {"id": i, "customer": {"id": 1 + i % 5}, "total_price": "1", "created_at": day(i)}) for i in range(1, 50)],
         abandoned_checkouts=[("s1", {"id": 1})])
    sync_all(spark, landing, tables, AS_OF)
    seen = []
    real_updated = R.updated

    def updated(run, path, changes, orders, as_of):
        class Once:
            def select(self, *a):
                seen.append(1)
                return orders.select(*a)
        return real_updated(run, path, changes, Once() if orders is not None else None, as_of)
    monkeypatch.setattr(R, "updated", updated)
    # an order amid the others changes its price: no history is read
    land(spark, landing, orders=[("s1", {"id": 20, "customer": {"id": 1}, "total_price": "9", "created_at": day(20)})])
    sync_all(spark, landing, tables, "2001-08-03 00:00:00")
    assert not seen
    assert_like_recompute(spark, tables)
    # the first order of a customer moves
    land(spark, landing, orders=[("s1", {"id": 1, "customer": {"id": 4}, "total_price": "1", "created_at": day(1)})])
    sync_all(spark, landing, tables, "2001-08-04 00:00:00")
    assert seen
    assert_like_recompute(spark, tables)


def test_pages_are_read_once(spark, tmp_dir):
    """A second sync opens no page; new pages only are applied; a restricted sync leaves the others' pages new."""
    landing, tables = f"{tmp_dir}/landing", C.Tables(f"{tmp_dir}/t")
    some = lambda *ids: [(s, {"id": i, "created_at": day(3)}) for s in ("s1", "s{2}") for i in ids]
    land(spark, landing, customers=some(1, 2), orders=some(1), abandoned_checkouts=some(1))
    first = sync_all(spark, landing, tables, "2001-08-01 00:00:00", stores=["s1"]).collect()
    assert {r.store_id for r in first} == {"s1"}
    second = sync_all(spark, landing, tables, "2001-08-02 00:00:00").collect()
    assert {r.store_id for r in second} == {"s{2}"}
    # the old pages cannot even be opened any more
    for folder, _, names in os.walk(landing):
        for name in names:
            if name.endswith(".txt"):
                os.remove(os.path.join(folder, "." + name + ".crc"))
                with open(os.path.join(folder, name), "w") as f:
                    f.write("{not to be read")
    assert sync_all(spark, landing, tables, "2001-08-03 00:00:00").collect() == []
    land(spark, landing, orders=some(9))
    third = sync_all(spark, landing, tables, "2001-08-04 00:00:00").collect()
    assert {(r.table_name, r.rows_loaded, r.success) for r in third if r.rows_loaded} == {("orders", 1, True)}
    assert spark.read.parquet(tables.path("orders")).count() == 4


def test_a_crash_between_resources_resumes(spark, tmp_dir, monkeypatch):
    """Customers are done, orders fail half way; the next sync starts with the orders' batch (K8, T4)."""
    landing, tables = f"{tmp_dir}/landing", C.Tables(f"{tmp_dir}/t")
    land(spark, landing, customers=[("s1", {"id": 1}), ("s1", "bad")], orders=[("s1", {"id": 1, "customer": {"id": 1}, "total_price": "3", "created_at": day(1)}), ("s1", {"id": 2, "total_price": "n/a"})],
         abandoned_checkouts=[("s1", {"id": 5})])
    real = PB.Run.seal

    def failing(self):
        if self.run_id.startswith("orders"):
            raise RuntimeError("lost")
        return real(self)
    monkeypatch.setattr(PB.Run, "seal", failing)
    with pytest.raises(Exception):
        sync_all(spark, landing, tables, AS_OF)
    assert not U.table_exists(spark, tables.path("orders"))
    monkeypatch.setattr(PB.Run, "seal", real)
    got = {r.table_name: (r.rows_loaded, r.rows_quarantined) for r in sync_all(spark, landing, tables, AS_OF).collect()}
    assert got == {"customers": (1, 1), "orders": (1, 1), "abandoned_checkouts": (1, 0)}
    assert_like_recompute(spark, tables)
    assert spark.read.parquet(tables.path("quarantine")).count() == 2


@pytest.mark.parametrize("lost_after", [4])
def test_all_or_nothing(spark, tmp_dir, monkeypatch, lost_after):
    """A failure after any write, then a rerun: table, quarantine and status of a clean run (K2)."""
    landing = f"{tmp_dir}/landing"
    land(spark, landing, customers=[("s1", {"id": 1}), ("s1", {"id": 2, "total_spent": "n/a"})], orders=[("s1", {"id": 1, "customer": {"id": 1}, "total_price": "3", "created_at": day(1)})],
         abandoned_checkouts=[("s1", {"id": 5, "customer": {"id": 1}})])
    clean, other = C.Tables(f"{tmp_dir}/clean"), C.Tables(f"{tmp_dir}/other")
    sync_all(spark, landing, clean, AS_OF)
    calls = itertools.count()
    upsert, replace = U.upsert_table, PB._replace

    def failing(real):
        def run(*args, **kw):
            out = real(*args, **kw)
            if next(calls) == lost_after:
                raise RuntimeError("lost")
            return out
        return run
    monkeypatch.setattr(U, "upsert_table", failing(upsert))
    monkeypatch.setattr(PB, "_replace", failing(replace))
    with pytest.raises(Exception):
        sync_all(spark, landing, other, AS_OF)
    monkeypatch.setattr(U, "upsert_table", upsert)
    monkeypatch.setattr(PB, "_replace", replace)
    sync_all(spark, landing, other, AS_OF)
    for table in ("customers", "orders", "abandoned_checkouts", "customer_rollups", "customer_metrics", "quarantine", "load_status"):
        rows = [sorted(map(str, spark.read.parquet(t.path(table)).drop("run_id", "page").collect())) for t in (clean, other)]
        assert rows[0] == rows[1] and rows[0], table


def test_a_failing_store_fails_alone(spark, tmp_dir):
    """Four stores load, the fifth has a page that cannot be read: an error state, and its pages are tried again (K9, A10)."""
    import gzip

    from lifetide.operators.reports import store_status
    from lifetide.plans.sync import last_status
    landing, tables = f"{tmp_dir}/landing", C.Tables(f"{tmp_dir}/t")
    names = [f"s{i}" for i in range(5)]
    land(spark, landing, customers=[(s, {"id": 1}) for s in names], orders=[(s, {"id": 1, "customer": {"id": 1}, "total_price": "3", "created_at": day(1)}) for s in names],
         abandoned_checkouts=[(s, {"id": 1}) for s in names])
    bad = f"{landing}/orders/store_id=s4/page.txt.gz"
    with open(bad, "wb") as f:
        f.write(b"this is no gzip")
    got = {(r.store_id, r.table_name): r for r in sync_all(spark, landing, tables, AS_OF).collect()}
    assert [got[s, "orders"].success for s in names] == [True] * 4 + [False] and got["s4", "orders"].error
    assert got["s4", "customers"].success and {r.store_id for r in spark.read.parquet(tables.path("orders")).collect()} == set(names[:4])
    registry = spark.createDataFrame([(s,) for s in (*names, "s9")], "store_id string")
    read = lambda n: U.read_or_empty(spark, tables.path(n), n)
    states = lambda: {r.store_id: r.status for r in store_status(read("customers"), read("orders"), registry, last_status(spark, tables)).collect()}
    assert states() == {**{s: "active" for s in (*names[:4], "s9")}, "s4": "error"}
    # mended: the held pages are read, no page twice
    with gzip.open(bad, "wb") as f:
        f.write(json.dumps({"id": 2, "customer": {"id": 1}, "total_price": "4", "created_at": day(2)}).encode())
    again = sync_all(spark, landing, tables, "2001-08-03 00:00:00").collect()
    assert {(r.store_id, r.table_name, r.rows_loaded) for r in again if r.rows_loaded} == {("s4", "orders", 2)}
    assert states()["s4"] == "active"
    assert_like_recompute(spark, tables)
    assert sync_all(spark, landing, tables, "2001-08-04 00:00:00").collect() == []


def test_an_unlisted_folder(spark, tmp_dir, monkeypatch):
    """A store whose folder cannot be listed gets an error row, the others load."""
    from lifetide.sources import landed as L
    landing, tables = f"{tmp_dir}/landing", C.Tables(f"{tmp_dir}/t")
    land(spark, landing, customers=[("s1", {"id": 1}), ("s2", {"id": 1})], orders=[("s1", {"id": 1})], abandoned_checkouts=[("s1", {"id": 1})])
    real = L.store_folders
    monkeypatch.setattr(L, "store_folders", lambda sp, root, res: (["s1"], {"s2": "denied"}) if res == "customers" else real(sp, root, res))
    sync_all(spark, landing, tables, AS_OF)
    got = {(r.store_id, r.table_name): (r.success, r.error) for r in status_of(spark, tables).collect()}
    assert got["s2", "customers"] == (False, "denied") and got["s1", "customers"] == (True, None)


def test_marks_and_the_window_drive_the_read(spark, tmp_dir):
    """Exported tables: the lowest mark bounds the scan, a late change inside the window is taken, none twice, marks move after the write."""
    import datetime as dt

    from lifetide.plans.sync import sync_exports
    from lifetide.sources import incremental as I
    tables, exports = C.Tables(f"{tmp_dir}/t"), f"{tmp_dir}/exports"
    at = lambda n: dt.datetime(2001, 1, 1) + dt.timedelta(days=n)
    schema = "store_id string, order_id long, customer_id string, total_price decimal(18,2), created_at timestamp_ntz, updated_at timestamp_ntz"

    def export(rows):
        from decimal import Decimal
        spark.createDataFrame([(s, i, str(c), Decimal(p), at(d), at(u)) for s, i, c, p, d, u in rows], schema).coalesce(1).write.mode("overwrite").parquet(f"{exports}/orders.parquet")
        spark.createDataFrame([(s, c, at(0)) for s in ("s1", "s2", "s3") for c in (1, 2)], "store_id string, customer_id long, updated_at timestamp_ntz") \
            .write.mode("overwrite").parquet(f"{exports}/customers.parquet")
    first = [("s1", i, 1, 10, i, i) for i in range(1, 40)] + [("s2", i, 2, 5, i, i) for i in range(100, 120)]
    export(first)
    assert sync_exports(spark, exports, tables, "2001-05-01 00:00:00") == {"customers": 6, "orders": 59}
    assert sync_exports(spark, exports, tables, "2001-05-02 00:00:00") == {"customers": 0, "orders": 0}
    marks = I.read_marks(spark, tables.root, "orders")
    assert {r.store_id: r.since_id for r in marks.collect()} == {"s1": 39, "s2": 119}
    # an old order changed long ago (outside the window), one changed late, a new one, an unseen store, a low id of another store
    export([("s1", 1, 1, 99, 1, 2), ("s1", 2, 2, 77, 2, 119)] + first[2:] + [("s1", 40, 1, 1, 40, 40), ("s3", 1, 1, 3, 1, 1), ("s2", 50, 2, 4, 50, 50)])
    read = I.read_window(spark.read.parquet(f"{exports}/orders.parquet"), marks, "order_id", "2001-05-03 00:00:00", 10)
    plan = read._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThan(order_id,39)" in pushed and "GreaterThanOrEqual(updated_at" in pushed
    assert sync_exports(spark, exports, tables, "2001-05-03 00:00:00", days=10) == {"customers": 0, "orders": 3}
    stored = {(r.store_id, r.order_id): float(r.total_price) for r in spark.read.parquet(tables.path("orders")).collect()}
    assert stored["s1", "2"] == 77 and stored["s1", "1"] == 10 and ("s1", "40") in stored and ("s3", "1") in stored and ("s2", "50") not in stored
    assert {r.store_id: r.since_id for r in I.read_marks(spark, tables.root, "orders").collect()} == {"s1": 40, "s2": 119, "s3": 1}
    assert sync_exports(spark, exports, tables, "2001-05-04 00:00:00", days=10) == {"customers": 0, "orders": 0}
    assert_like_recompute(spark, tables)
