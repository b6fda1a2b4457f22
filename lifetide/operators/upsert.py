"""Upsert, insert-if-absent and table writes on plain Parquet (K1-K7).

Merge logic is a join on the key: the staged batch is first reduced to one
row per key (W1), so both join sides hold at most one row per key and no key
can skew the join.

Writing: a Parquet folder partitioned by store and key bucket.  New keys
(insert mode) are appended and rewrite nothing.  A merge stages the rows of
the touched partitions in the shared checkpoint folder (cutting the lineage
to the files being replaced), replaces those partitions by dynamic partition
overwrite, and removes the staged files.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.operators.dedup import latest_by_updated, latest_non_null_per_key, latest_per_key  # noqa: F401
from lifetide.schemas import STATUS_NEW, STORED
from lifetide.session import checkpoint_dir

_PRESENT = "_src_present"
_PRESENT_T = "_tgt_present"


def _merge(target: DataFrame, source: DataFrame, keys: list[str], pick,
           with_flag: bool = False) -> DataFrame:
    """Full-outer join of target and a one-row-per-key source; ``pick``
    decides each staged column from (source column, target column).
    ``with_flag`` keeps a ``_tgt_present`` column (key was stored before)."""
    s = source.withColumn(_PRESENT, F.lit(True))
    t = target.withColumn(_PRESENT_T, F.lit(True))
    staged = [c for c in source.columns if c not in keys]
    t_only = [c for c in target.columns if c not in keys and c not in staged]
    ta, sa = t.alias("t"), s.alias("s")
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    j = ta.join(sa, cond, "full_outer")
    present = F.coalesce(F.col(f"s.{_PRESENT}"), F.lit(False))
    cols = [F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
    for c in staged:
        tc = F.col(f"t.{c}") if c in target.columns else F.lit(None)
        cols.append(pick(present, F.col(f"s.{c}"), tc, c).alias(c))
    cols += [F.col(f"t.{c}").alias(c) for c in t_only]
    if with_flag:
        cols.append(F.coalesce(F.col(f"t.{_PRESENT_T}"), F.lit(False)).alias(_PRESENT_T))
    return j.select(*cols)


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           newest_first: list | None = None, drop: list[str] = ()) -> DataFrame:
    """MERGE semantics (K3, K4): the staged batch is reduced to its latest
    row per key; a matched key takes every staged column from the source,
    target-only columns keep their value; an unmatched staged key is
    inserted (target-only columns NULL); target rows not staged stay.
    ``drop`` names ordering-only columns (arrival sequence) not stored."""
    if newest_first is not None:
        src = latest_per_key(source, keys, newest_first, drop=list(drop))
    else:
        src = latest_by_updated(source, keys)
    return _merge(target, src, keys,
                  lambda present, s, t, c: F.when(present, s).otherwise(t))


def upsert_keep_missing(target: DataFrame, source: DataFrame, keys: list[str],
                        newest_first: list, new_defaults: dict[str, Column] | None = None,
                        drop: list[str] = ()) -> DataFrame:
    """Insert-or-update where a missing (NULL) value keeps the stored one (K6).

    Applying a batch of change events one after another means: per column,
    the newest non-missing value in the batch, else the stored value.  That
    is one aggregate per key (no ordering of the events in one task).  New
    keys get ``new_defaults`` for columns still empty (status 'new', ...)."""
    src = latest_non_null_per_key(source, keys, newest_first, drop=list(drop))
    defaults = new_defaults or {}
    merged = _merge(target, src, keys, lambda present, s, t, c: F.coalesce(s, t), with_flag=True)
    is_new = ~F.col(_PRESENT_T)
    for c, d in defaults.items():
        if c in merged.columns:
            merged = merged.withColumn(c, F.when(is_new, F.coalesce(F.col(c), d)).otherwise(F.col(c)))
        else:
            merged = merged.withColumn(c, F.when(is_new, d))
    return merged.drop(_PRESENT_T)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` whose key is not stored yet (K5, J8); an existing
    key is left untouched even when the batch carries a changed row."""
    return source.join(target.select(*keys), keys, "left_anti")


def new_customer_defaults() -> dict[str, Column]:
    """Fixed values for a customer first seen in a change event (K6)."""
    return {"status": F.lit(STATUS_NEW), "orders_count": F.lit(0),
            "total_spent": F.lit(0).cast("decimal(18,2)")}


# --------------------------------------------------------------------- writes
# Tables are folders partitioned by (store_id, key_bucket).  The bucket is a
# hash of the row key, so a batch of changes touches only the buckets of its
# keys: even a store that holds a third of all rows is rewritten one bucket
# at a time, never as a whole.
KEY_BUCKET = "key_bucket"
N_BUCKETS = 64
PARTITIONS = ["store_id", KEY_BUCKET]


def bucket_of(key_col: str, n: int = N_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key_col)), F.lit(n)).cast("int")


def _stored_schema(name: str):
    from pyspark.sql import types as T
    return T.StructType([*STORED[name].fields, T.StructField(KEY_BUCKET, T.IntegerType(), True)])


BUCKETS_CONF = "lifetide.upsert.buckets"


def table_buckets(spark: SparkSession, path: str) -> int:
    """Bucket count of a table, fixed when the table is created and kept in a
    hidden marker file (Spark skips '_' paths when reading the table).  A
    table's count never changes, so a key always maps to the same bucket."""
    marker = f"{path.rstrip('/')}/_lifetide_buckets"
    if table_exists(spark, marker):
        return int(spark.read.text(marker).first()[0])
    n = int(spark.conf.get(BUCKETS_CONF, str(N_BUCKETS)))
    spark.createDataFrame([(str(n),)], "value string").coalesce(1).write.mode("overwrite").text(marker)
    return n


def create_table(spark: SparkSession, path: str, name: str) -> int:
    """Create an empty table folder with the canonical schema if absent (K7);
    returns its bucket count."""
    if not table_exists(spark, path):
        spark.createDataFrame([], _stored_schema(name)).write.mode("ignore") \
            .partitionBy(*PARTITIONS).parquet(path)
    return table_buckets(spark, path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_or_empty(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The stored table (with its key_bucket partition column), or an empty one."""
    if table_exists(spark, path):
        return spark.read.schema(_stored_schema(name)).parquet(path)
    return spark.createDataFrame([], _stored_schema(name))


def by_folder(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cluster rows by output folder before a partitioned write (REBALANCE).

    Without it every write task holds rows of many folders and writes one
    small file into each.  AQE sizes the rebalance: a folder that holds a
    third of all rows is split into advisory-size pieces, small folders are
    merged, so each folder gets a few right-sized files."""
    return df.hint("rebalance", *[F.col(c) for c in cols])


def append(df: DataFrame, path: str, name: str) -> None:
    """Plain append of canonical rows, one job-level commit per call (K1, K2),
    in the table's own layout; the table is created if absent."""
    from lifetide.schemas import KEYS
    n = create_table(df.sparkSession, path, name)
    rows = conform(df, name).withColumn(KEY_BUCKET, bucket_of(KEYS[name], n))
    by_folder(rows, PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


@contextmanager
def staged(df: DataFrame):
    """``df`` written to the shared checkpoint folder and read back; the files
    go when the block ends, whatever happens in it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs.delete(hpath, True)


def _renamed(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def rebucket(spark: SparkSession, path: str, name: str, n: int) -> None:
    """Change a table's bucket count (maintenance; no other writer may run):
    the table is rewritten beside itself, steps aside, and goes once the new
    one has its place.  A failure leaves the old table, at its place or aside;
    the next call puts it back first."""
    from lifetide.schemas import KEYS
    jvm = spark.sparkContext._jvm
    old, new, aside = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", "-rebucket", "-aside"))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(aside):
        if fs.exists(old):
            fs.delete(aside, True)          # it failed after the new table had its place
        else:
            _renamed(fs, aside, old)
    rows = read_or_empty(spark, path, name).withColumn(KEY_BUCKET, bucket_of(KEYS[name], n))
    by_folder(rows, PARTITIONS).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(new.toString())
    spark.createDataFrame([(str(n),)], "value string").coalesce(1).write.mode("overwrite").text(f"{new}/_lifetide_buckets")
    if fs.exists(old):
        _renamed(fs, old, aside)
    _renamed(fs, new, old)
    fs.delete(aside, True)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast and order to the canonical schema; absent columns become NULL."""
    schema = STORED[name]
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def read_touched(spark: SparkSession, path: str, name: str, batch: DataFrame, key: str,
                 n: int) -> DataFrame:
    """Stored rows of the (store, bucket) partitions that ``batch`` touches.

    The touched set (at most stores x n rows) is materialised first, so Spark
    knows its real size and broadcasts it if that is under the threshold; it
    is not hinted, since stores are data.  With the broadcast, dynamic
    partition pruning reads only those partition folders: it needs a
    broadcast to reuse and a filter it deems selective on the pruning side,
    which the always-true bucket range supplies.  Beyond the threshold the
    semi join shuffles."""
    parts = batch.select("store_id", bucket_of(key, n).alias(KEY_BUCKET)).distinct().persist()
    parts.count()
    out = (read_or_empty(spark, path, name)
           .join(parts.filter(F.col(KEY_BUCKET).between(0, n - 1)), PARTITIONS, "left_semi").drop(KEY_BUCKET))
    out.touched_parts = parts
    return out


def release(*touched: DataFrame) -> None:
    """Let go of the touched sets behind frames of ``read_touched`` (after their last use)."""
    for df in touched:
        df.touched_parts.unpersist()


def touched_rows(spark: SparkSession, path: str, name: str, keys: DataFrame) -> DataFrame:
    """Stored rows of ``keys`` (store_id and the table's key), reading only the partitions they are in.

    A table that is not there has none; it is not created, as reading changes nothing."""
    from lifetide.schemas import KEYS
    key = KEYS[name]
    n = table_buckets(spark, path) if table_exists(spark, path) else N_BUCKETS
    stored = read_touched(spark, path, name, keys, key, n)
    out = stored.join(keys.select("store_id", key).distinct(), ["store_id", key], "left_semi")
    out.touched_parts = stored.touched_parts
    return out


def upsert_table(spark: SparkSession, path: str, name: str, batch: DataFrame,
                 mode: str = "upsert", newest_first: list | None = None,
                 seq: str | None = None) -> None:
    """Apply a staged batch to the table at ``path``.

    ``mode``: 'upsert' (K3/K4), 'arrival' (the same with the last arrival by
    ``seq`` as a key's row, W2), 'keep_missing' (K6) or 'insert' (K5).
    Only the (store, key bucket) partitions the batch touches are read
    (dynamic partition pruning on the semi join).  'insert' appends the keys
    that are new; the others merge, stage and replace those partitions.
    Applying the same batch twice gives the same table.
    """
    from lifetide.schemas import KEYS
    key = KEYS[name]
    keys = ["store_id", key]
    n = create_table(spark, path, name)
    touched = read_touched(spark, path, name, batch, key, n)
    if mode == "insert":
        src = latest_by_updated(batch, keys, seq) if newest_first is None else \
            latest_per_key(batch, keys, newest_first, drop=[seq] if seq else [])
        # staged, as the rows to append are found by reading the table itself
        with staged(conform(insert_if_absent(touched, src, keys), name)) as fresh:
            append(fresh, path, name)
        release(touched)
        return
    if mode == "arrival":
        newest_first = [seq]
    if mode == "keep_missing":
        merged = upsert_keep_missing(touched, batch, keys, newest_first or ["updated_at"],
                                     new_customer_defaults() if name == "customers" else None,
                                     [seq] if seq else [])
    else:
        merged = upsert(touched, batch, keys, newest_first, [seq] if seq else [])
    with staged(conform(merged, name).withColumn(KEY_BUCKET, bucket_of(key, n))) as out:
        (by_folder(out, PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITIONS).parquet(path))
    release(touched)
