"""Key checks, unknown stores and quarantine on hand fixtures."""

import json

from lifetide.operators import flatten as P
from lifetide.operators import quality as Q
from lifetide.schemas import ORDER_PAYLOAD, ORDERS


def test_orphans_and_null_fk(spark):
    parents = spark.createDataFrame([("s1", "c1")], "store_id string, customer_id string")
    orders = spark.createDataFrame([("s1", "o1", "c1"), ("s1", "o2", "c404"), ("s1", "o3", None)],
                                   "store_id string, order_id string, customer_id string")
    items = spark.createDataFrame([("i1", "o1"), ("i2", "o9"), ("i3", None)], "order_item_id string, order_id string")
    out = {r.relation: r.orphans for r in Q.fk_orphans({
        "orders.customer_id": (orders, parents, ["store_id", "customer_id"]),
        "order_items.order_id": (items, orders, ["order_id"])}).collect()}
    assert out == {"orders.customer_id": 1, "order_items.order_id": 1}


def test_pk_violations_same_id_two_stores_is_fine(spark):
    df = spark.createDataFrame([("s1", "1"), ("s2", "1"), ("s1", "2"), ("s1", "2")], "store_id string, id string")
    got = [(r.key, r.n_rows) for r in Q.pk_violations({"t": (df, ["store_id", "id"])}).collect()]
    assert got == [("s1|2", 2)]


def test_unknown_store_refuses_whole_request(spark):
    reg = spark.createDataFrame([("a",), ("b",)], "store_id string")
    req = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "zzz")], "request_id int, store_id string")
    got = {(r.request_id, r.store_id): (r.known, r.accepted) for r in Q.unknown_stores(req, reg).collect()}
    assert got == {(1, "a"): (True, True), (1, "b"): (True, True),
                   (2, "a"): (True, False), (2, "zzz"): (False, False)}


def test_quarantine_and_load_status(spark):
    rows = [("s1", json.dumps({"id": 1, "total_price": "1.00"})),
            ("s1", json.dumps({"id": 2, "total_price": "n/a"})),
            ("s2", "{not json"), ("s2", json.dumps({"id": 3, "created_at": "yesterday"})),
            ("s3", json.dumps({"id": 4}))]
    flagged = Q.flag(P.parse(spark.createDataFrame(rows, "store_id string, payload string"), ORDER_PAYLOAD), "orders")
    st = {r.store_id: (r.rows_loaded, r.rows_quarantined, r.success)
          for r in Q.load_status(flagged, "orders").collect()}
    assert st == {"s1": (1, 1, False), "s2": (0, 2, False), "s3": (1, 0, True)}


def test_column_listing_and_missing_tables(spark):
    df = spark.createDataFrame([], ORDERS)
    listing = Q.column_listing(df, spark, ORDERS).collect()
    assert len(listing) == len(ORDERS.fields) and all(r.matches_canonical for r in listing)
    miss = [r.table_name for r in Q.missing_tables(spark, ["customers", "orders", "refunds"],
                                                   ["ORDERS", "Customers"]).collect()]
    assert miss == ["refunds"]


def test_null_key_parts_do_not_merge(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("b", "c"), ("b", "c")], "store_id string, id string")
    got = [(r.key, r.n_rows) for r in Q.pk_violations({"t": (df, ["store_id", "id"])}).collect()]
    assert got == [("b|c", 2)]


def test_compare_names_ignores_case(spark):
    names = lambda *v: spark.createDataFrame([(x,) for x in v], "name string")
    got = [(r.name, r.present) for r in Q.compare_names(names("Orders", "REFUNDS", "orders"), names("ORDERS", "x")).collect()]
    assert got == [("orders", True), ("refunds", False)]


def test_store_status_lists_registered_and_failed_stores(spark):
    from lifetide.operators import reports as R
    customers = spark.createDataFrame([("s1", "1")], "store_id string, customer_id string")
    orders = spark.createDataFrame([], "store_id string, order_id string, created_at timestamp_ntz")
    registry = spark.createDataFrame([("s1",), ("s2",)], "store_id string")
    status = spark.createDataFrame([("s1", True), ("s1", False), ("s2", True)], "store_id string, success boolean")
    got = {r.store_id: (r.customer_count, r.order_count, r.status) for r in R.store_status(customers, orders, registry, status).collect()}
    assert got == {"s1": (1, 0, "error"), "s2": (0, 0, "active")}


def test_counted_listing(spark):
    df = spark.createDataFrame([("s1", None), ("s2", 3)], "store_id string, `odd.name` int")
    got = [(r.column_name, r.data_type, r.n_values, r.matches_canonical) for r in Q.column_listing(df, spark, ORDERS, counted=True).collect()]
    assert got == [("store_id", "string", 2, True), ("odd.name", "int", 1, False)]


def test_footer_drift_names_the_file(spark, tmp_dir):
    from pyspark.sql import types as T
    declared = T.StructType.fromDDL("store_id string, id string, total decimal(18,2), at timestamp_ntz")
    for store, total in (("s1", "decimal(18,2)"), ("s2", "decimal(18,2)"), ("s3", "double")):
        spark.sql(f"SELECT 'a' AS id, CAST(1 AS {total}) AS total, TIMESTAMP_NTZ '2001-01-01' AS at").coalesce(1) \
            .write.parquet(f"{tmp_dir}/orders/store_id={store}")
    assert not [r for r in Q.footer_drift(spark, f"{tmp_dir}/orders", declared).collect() if "s3" not in r.file]
    spark.sql("SELECT 'a' AS id, 1 AS more, CAST(1 AS decimal(18,2)) AS total").coalesce(1).write.parquet(f"{tmp_dir}/orders/store_id=s4")
    with open(f"{tmp_dir}/orders/broken.parquet", "wb") as f:
        f.write(b"no footer")
    got = {(r.file.split("/orders/")[1].split("/")[0], r.column_name, r.found_type, r.expected_type, r.problem)
           for r in Q.footer_drift(spark, f"{tmp_dir}/orders", declared).collect()}
    assert got == {("store_id=s3", "total", "double", "decimal(18,2)", "type"), ("store_id=s4", "more", "int", None, "extra"),
                   ("store_id=s4", "at", None, "timestamp_ntz", "missing"), ("broken.parquet", None, None, None, "unreadable")}
