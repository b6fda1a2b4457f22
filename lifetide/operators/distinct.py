"""Distinct counts that merge (A2): bitmaps of numeric ids.

An increment of rows becomes one bitmap per group and bucket of 32,768 ids
(Spark's own bitmap aggregates, combined map-side, so a hot group is one bitmap per
task and bucket).  Bitmaps of increments are merged by OR, so an id that is
delivered twice, in one increment or in two, counts once; counts are exact.  No
increment is read again to count, and none needs to know the others.

Stored increments are folders by run (``publish.BY_RUN``): a run that comes again
replaces what it wrote.  ``compact`` folds them into one; as OR may be repeated, a
failure half way leaves counts as they were.

For groups whose ids are dense (a store's orders, products, customers): a bitmap
takes 4 KB before compression however few of its ids are set.  NULL ids are not
counted, as in COUNT(DISTINCT).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifetide.operators.publish import BY_RUN, Run, path_safe, read_by_run
from lifetide.operators.upsert import by_folder


def bitmaps(rows: DataFrame, group: list[str], id_col: str) -> DataFrame:
    """(group, bucket, bits) of the ids of ``rows``."""
    ids = rows.select(*group, F.col(id_col).cast("long").alias("_id")).filter(F.col("_id").isNotNull())
    return (ids.groupBy(*group, F.bitmap_bucket_number("_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits")))


def merged(maps: DataFrame, group: list[str]) -> DataFrame:
    """One bitmap per group and bucket."""
    return maps.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(maps: DataFrame, group: list[str], name: str) -> DataFrame:
    """Distinct ids per group."""
    return (merged(maps, group).groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias(name)))


def add(run: Run, table: str, rows: DataFrame, group: list[str], id_col: str) -> None:
    """Stage the bitmaps of an increment (``group`` begins with store_id)."""
    run.stage(table, bitmaps(rows, group, id_col), BY_RUN)


def read(spark: SparkSession, root: str, table: str, group: list[str]) -> DataFrame:
    """The bitmaps of all increments."""
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in group], T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())])
    return read_by_run(spark, root, table, schema)


def compact(spark: SparkSession, root: str, table: str, group: list[str], name: str) -> None:
    """Fold all increments into one, called ``name``; the others go once it is there."""
    maps = read(spark, root, table, group)
    old = [r["run_id"] for r in maps.select("run_id").distinct().collect()]
    if len(old) < 2:
        return
    base, name = f"{root.rstrip('/')}/{table}", path_safe(name)
    by_folder(merged(maps, group), ["store_id"]).write.mode("errorifexists").parquet(f"{base}/run_id={name}")
    jvm = spark.sparkContext._jvm
    for run_id in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/run_id={run_id}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
