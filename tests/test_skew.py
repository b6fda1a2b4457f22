"""A key holding a third of all rows: results stay exact when AQE splits
skewed partitions (thresholds forced tiny), compared with brute force."""

import datetime as dt
from decimal import Decimal

from lifetide.operators import dedup as D
from lifetide.operators import metrics as M
from lifetide.operators import reports as R

D0 = dt.datetime(2024, 1, 1)
FORCE_SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_customer_profile_and_summary(spark):
    n = 3000
    orders = [("s", f"o{i}", "hot" if i % 3 == 0 else f"c{i % 50}", Decimal(i % 97) + Decimal("0.25"),
               D0 + dt.timedelta(minutes=i)) for i in range(n)]
    customers = sorted({(o[0], o[2]) for o in orders})
    refunds = [(f"r{i}", f"o{i}", Decimal("1.10")) for i in range(0, n, 4)]
    checkouts = [("s", f"k{i}", "hot" if i % 3 == 0 else f"c{i % 50}") for i in range(300)]
    cdf = spark.createDataFrame([(s, c, c + "@x", "F", "L", "enabled") for s, c in customers],
                                "store_id string, customer_id string, email string, first_name string, "
                                "last_name string, customer_state string")
    odf = spark.createDataFrame(orders, "store_id string, order_id string, customer_id string, "
                                        "total_price decimal(18,2), created_at timestamp_ntz")
    rdf = spark.createDataFrame([(r, o, a, D0) for r, o, a in refunds],
                                "refund_id string, order_id string, amount decimal(18,2), created_at timestamp_ntz")
    kdf = spark.createDataFrame(checkouts, "store_id string, checkout_id string, customer_id string")

    got = with_conf(spark, FORCE_SKEW, lambda: {
        r.customer_id: r for r in M.clv_profile(cdf, odf, kdf, rdf, literal=True).collect()})
    owner = {o[1]: o[2] for o in orders}
    for cust in ("hot", "c1"):
        mine = [o for o in orders if o[2] == cust]
        refunded = sum((a for _, o, a in refunds if owner[o] == cust), Decimal(0))
        k = sum(1 for c in checkouts if c[2] == cust)
        assert got[cust].total_orders == len(mine)
        assert got[cust].total_spent == float(sum(o[3] for o in mine))
        assert got[cust].total_refunded == float(refunded * max(k, 1))

    items = spark.createDataFrame([(f"i{j}", f"o{j % n}") for j in range(2 * n)],
                                  "order_item_id string, order_id string")
    summ = with_conf(spark, FORCE_SKEW, lambda: {
        r.customer_id: r for r in R.customer_summary(cdf, odf, items).collect()})
    assert summ["hot"].order_count == n // 3 and summ["hot"].total_items == 2 * (n // 3)


def test_hot_key_dedup(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", i, f"v{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    got = with_conf(spark, FORCE_SKEW, lambda: {
        r.k: r.v for r in D.dedup_keep_last(df, ["k"], "seq").collect()})
    want = {}
    for k, s, v in rows:
        want[k] = v
    assert got == want
