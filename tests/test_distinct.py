"""Distinct counts that merge (A2)."""

import random

from lifetide.operators import distinct as DC
from lifetide.operators.publish import Run

GROUP = ["store_id"]


def test_ten_increments(spark, tmp_dir):
    """Counts after every increment equal COUNT(DISTINCT) of all rows; ids delivered twice count once; a rerun and a compaction change nothing."""
    rnd = random.Random(3)
    rows = []
    for n in range(10):
        part = [(f"s{rnd.randrange(3)}", rnd.choice((rnd.randrange(100_000), rnd.randrange(50), -rnd.randrange(70_000), 2**62 + rnd.randrange(9), None))) for _ in range(300)]
        rows += part
        df = spark.createDataFrame(part, "store_id string, id long")
        for _ in range(2 if n % 3 == 0 else 1):     # the same run again replaces itself
            run = Run(spark, tmp_dir, f"run-{n}")
            DC.add(run, "ids", df, GROUP, "id")
            run.commit()
        if n == 5:
            DC.compact(spark, tmp_dir, "ids", GROUP, "compact-1")
            DC.compact(spark, tmp_dir, "ids", GROUP, "compact-2")
    want = {s: len({i for t, i in rows if t == s and i is not None}) for s in ("s0", "s1", "s2")}
    counted = lambda: {r.store_id: r.n for r in DC.counts(DC.read(spark, tmp_dir, "ids", GROUP), GROUP, "n").collect()}
    assert counted() == want
    DC.compact(spark, tmp_dir, "ids", GROUP, "compact-3")
    maps = DC.read(spark, tmp_dir, "ids", GROUP)
    assert counted() == want and {r.run_id for r in maps.select("run_id").distinct().collect()} == {"compact-3"}
    assert maps.count() == DC.merged(maps, GROUP).count()


def test_hot_group_is_combined_before_the_shuffle(spark):
    plan = DC.counts(DC.bitmaps(spark.range(1000).selectExpr("'s' AS store_id", "id"), GROUP, "id"), GROUP, "n")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "partial_bitmap_or_agg" in plan
