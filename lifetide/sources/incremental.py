"""Cursor reads: ascending-id high-water marks per store.

Marks are one row per (store, resource) -- bounded by the number of stores,
not by the data -- and are joined to the batch by store.  A single global
mark is a literal filter; on a numeric id column it pushes into the Parquet scan.
Marks are kept in a small table of their own (``read_marks``, ``save_marks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators.upsert import staged, table_exists

MARKS = "store_id string, since_id long"


def id_number(col: str = "id"):
    return F.col(col).cast("long")


def marks_of(df: DataFrame, id_col: str, store_col: str = "store_id") -> DataFrame:
    """High-water mark per store: max(int(id))."""
    return df.groupBy(store_col).agg(F.max(id_number(id_col)).alias("since_id"))


def flag_new(df: DataFrame, id_col: str, marks: DataFrame, store_col: str = "store_id") -> DataFrame:
    """``df`` with its store's ``since_id`` and whether its id ``is_new`` (no mark: everything is)."""
    m = marks.select(store_col, "since_id")
    return (df.join(m, store_col, "left")
            .withColumn("is_new", F.col("since_id").isNull() | (id_number(id_col) > F.col("since_id"))))


def since(df: DataFrame, id_col: str, marks: DataFrame | int | None,
          store_col: str = "store_id") -> DataFrame:
    """Rows with id > the store's mark (S2).  No mark -> everything."""
    if marks is None:
        return df
    if isinstance(marks, int):
        # a numeric id is compared as it is, so the filter reaches the scan
        numeric = df.schema[id_col].dataType.typeName() in ("long", "integer")
        return df.filter((F.col(id_col) if numeric else id_number(id_col)) > F.lit(marks))
    return flag_new(df, id_col, marks, store_col).filter("is_new").drop("since_id", "is_new")


def within_lookback(df: DataFrame, as_of, days: int = X.DEFAULT_LOOKBACK_DAYS, ts_col: str = "created_at") -> DataFrame:
    """Rows created within ``days`` before ``as_of`` (S3, F2); with ``since`` or ``flag_new``, cursor plus lookback."""
    return df.filter(F.col(ts_col) >= X.lookback_start(as_of, days))


def advance(marks: DataFrame | None, batch: DataFrame, id_col: str,
            store_col: str = "store_id") -> DataFrame:
    """New marks after a batch: the batch maximum, or the old mark when the
    store read nothing new."""
    new = marks_of(batch, id_col, store_col).withColumnRenamed("since_id", "_new")
    if marks is None:
        return new.withColumnRenamed("_new", "since_id")
    return (marks.join(new, store_col, "full_outer")
            .select(store_col, F.greatest(F.col("since_id"), F.col("_new")).alias("since_id")))


def read_marks(spark: SparkSession, root: str, resource: str) -> DataFrame | None:
    """The stored marks of a resource; None before its first read."""
    path = f"{root.rstrip('/')}/marks/resource={resource}"
    return spark.read.schema(MARKS).parquet(path) if table_exists(spark, path) else None


def save_marks(marks: DataFrame, root: str, resource: str) -> None:
    """Replace the stored marks of a resource (after its batch was stored)."""
    with staged(marks.select("store_id", F.col("since_id").cast("long").alias("since_id"))) as rows:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/marks/resource={resource}")


def read_new(df: DataFrame, root: str, resource: str, id_col: str) -> DataFrame:
    """Rows above their store's stored mark (S2); call ``mark_read`` once they are stored."""
    return since(df, id_col, read_marks(df.sparkSession, root, resource))


def read_window(df: DataFrame, marks: DataFrame | None, id_col: str, as_of, days: int = X.DEFAULT_LOOKBACK_DAYS,
                ts_col: str = "updated_at") -> DataFrame:
    """Rows above their store's mark, and rows changed in the ``days`` before ``as_of`` whatever their id (S2 with S3).

    The lowest mark and the start of the window go into the scan as one filter
    (row groups below both are skipped); each store's own mark is compared after
    it.  A store without a mark is read whole, so its name is part of the filter.
    Marks are one row per store."""
    if marks is None:
        return df
    known = marks.filter("since_id is not null").select("store_id", "since_id")
    rows = known.collect()
    if not rows:
        return df
    numeric = df.schema[id_col].dataType.typeName() in ("long", "integer")
    own = F.col(id_col) if numeric else id_number(id_col)
    late = F.col(ts_col) >= X.lookback_start(as_of, days)
    unmarked = F.col("store_id").isNull() | ~F.col("store_id").isin([r["store_id"] for r in rows])
    scanned = df.filter((own > F.lit(min(r["since_id"] for r in rows))) | late | unmarked)
    marked = scanned.join(known, "store_id", "left")
    return marked.filter(F.col("since_id").isNull() | (own > F.col("since_id")) | late).drop("since_id")


def changed_only(batch: DataFrame, stored: DataFrame, keys: list[str], ts_col: str = "updated_at") -> DataFrame:
    """Rows of ``batch`` that are not stored yet, or are newer than what is stored: the window is read again, no row is taken twice."""
    old = stored.select(*keys, F.col(ts_col).alias("_stored_at"), F.lit(True).alias("_stored"))
    newer = F.col("_stored").isNull() | (F.col(ts_col) > F.col("_stored_at")) | (F.col(ts_col).isNotNull() & F.col("_stored_at").isNull())
    return batch.join(old, keys, "left").filter(newer).drop("_stored_at", "_stored")


def mark_read(batch: DataFrame, root: str, resource: str, id_col: str) -> None:
    """Move the stored marks on to the batch's highest ids (T4)."""
    save_marks(advance(read_marks(batch.sparkSession, root, resource), batch, id_col), root, resource)
