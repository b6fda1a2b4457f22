"""Scale properties of every registered plan (sf0.001 plans, same shape at
any scale): no cross products or nested-loop joins, no windows (dedup is an
aggregate), no Python evaluation, pruned and pushed-down scans."""

import pytest

from conftest import SF_SMALL

from lifetide.plans.catalog import get_queries

QUERIES = get_queries()
PLANNED = sorted(n for n in QUERIES if n != "clv_predictions")  # that one trains on call


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_plan_shape(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "Window [", "RoundRobin"):
        assert bad not in plan, f"{name}: {bad}"


def test_lookback_filter_reaches_parquet(spark):
    plan = plan_of(QUERIES["lookback_orders"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_scans_read_only_needed_columns(spark):
    df = QUERIES["record_counts"](spark, SF_SMALL)
    plan = plan_of(df)
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_aggregates_are_partial_before_shuffle(spark):
    plan = plan_of(QUERIES["customer_metrics"](spark, SF_SMALL))
    assert "partial_sum" in plan and "partial_count" in plan


def test_shuffle_partitions_sized_by_input():
    from lifetide.session import TARGET_PARTITION_BYTES, shuffle_partitions_for
    assert shuffle_partitions_for(1_000, cores=8) == 16            # small: two per core
    assert shuffle_partitions_for(TARGET_PARTITION_BYTES * 100 + 1, cores=8) == 101
    # 100 TB: partitions stay ~256 MB of input each
    n = shuffle_partitions_for(100 * 10**12, cores=8000)
    assert 100 * 10**12 / n <= TARGET_PARTITION_BYTES


def test_cursor_reaches_parquet(spark):
    from lifetide.sources import incremental as I
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = plan_of(I.since(orders, "o_orderkey", 500))
    assert "GreaterThan(o_orderkey,500)" in plan


def test_incremental_reads_orders_twice(spark):
    assert plan_of(QUERIES["incremental_since_id"](spark, SF_SMALL)).count("FileScan parquet") == 2


def test_shuffles_are_sized_by_the_input(spark):
    from lifetide.session import input_bytes, shuffle_partitions_for, size_shuffles
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        size_shuffles(spark, SF_SMALL)
        want = shuffle_partitions_for(input_bytes(spark, SF_SMALL), spark.sparkContext.defaultParallelism)
        assert input_bytes(spark, SF_SMALL) > 0 and spark.conf.get("spark.sql.shuffle.partitions") == str(want)
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        size_shuffles(spark, SF_SMALL)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"      # a choice stays
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("name,parses", [("flatten_orders", 1), ("money_parse", 1), ("iso_timestamps", 1), ("explode_line_items", 1), ("store_load_status", 3),
                                         ("store_status", 1), ("flatten_customers", 1), ("flatten_checkouts", 1), ("flatten_refunds", 1)])
def test_every_record_is_parsed_once(spark, name, parses):
    """No optimiser rule copies a JSON parse into a filter or a second projection."""
    plan = get_queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan()
    lines = [line for line in plan.toString().split("\n") if "from_json(" in line]
    assert len(lines) == parses and not any(line.lstrip(" :+-").startswith("Filter") for line in lines)


def test_a_task_reads_little_whatever_the_input(spark):
    """6 GB on 12 cores: a key count holds a few million keys in a task, as over 1 GB (V3)."""
    from lifetide.session import TASK_BYTES, shuffle_partitions_for, size_shuffles
    assert shuffle_partitions_for(6 * 10**9, cores=12) == 90
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", *TASK_BYTES)}
    try:
        for k in TASK_BYTES:
            spark.conf.unset(k)
        size_shuffles(spark, SF_SMALL)
        assert {k: spark.conf.get(k) for k in TASK_BYTES} == dict.fromkeys(TASK_BYTES, "32MB")
        for k in TASK_BYTES:
            spark.conf.set(k, "8m")
        size_shuffles(spark, SF_SMALL)
        assert {spark.conf.get(k) for k in TASK_BYTES} == {"8m"}      # a choice stays
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
