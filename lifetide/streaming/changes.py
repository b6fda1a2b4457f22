"""Change-event intake with Structured Streaming.

A change event is one JSON line ``{"store_id", "customer"?, "order"?}``.
Each micro-batch is applied with ``foreachBatch``:

1. lines, customers, orders and items that cannot be stored as they are go to
   the quarantine table (K9); nothing vanishes and nothing stops the stream
2. customer parts  -> insert-or-update keeping stored values for missing
   fields (K6); a new customer gets status 'new'              (T1)
3. order parts     -> inserted if absent, the items of a new order with it; an
   order that is stored stays as it is, its items too (K5)    (T1)
4. customers of the new orders get their roll-up, status and metrics by
   differences (T2, operators/rollups.py); no order history is read

All of it is one run, named by the query's own id (kept in its checkpoint) and the
batch, staged together and then published (operators/publish.py).  A batch that
failed on the way is published by whoever writes next, another stream or a
sync; a batch that comes again finds its orders stored and changes nothing (T3).  A file
source with ``trigger(availableNow=True)`` and a checkpoint is the resumable
cursor (T4).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lifetide.functions import scalars as X
from lifetide.operators import flatten as P
from lifetide.operators import quality as Q
from lifetide.operators import rollups as R
from lifetide.operators import upsert as U
from lifetide.operators.publish import BY_RUN, Run, recover
from lifetide.schemas import CHANGE_EVENT, CORRUPT, QUARANTINE


@dataclass(frozen=True)
class Tables:
    """Folder of each stored table (partitioned by store_id)."""
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def read_changes(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    """Streaming read of landed change-event JSON files (explicit schema); the
    text of a line that cannot be read is kept in its own column."""
    r = (spark.readStream.schema(T.StructType([*CHANGE_EVENT.fields, T.StructField(CORRUPT, T.StringType(), True)]))
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(source_dir)


def event_time(df: DataFrame):
    """Event time of a change (an instant, as watermarks need): the order's,
    else the customer's updated_at / created_at."""
    t = lambda c: F.try_to_timestamp(F.col(c))
    return F.coalesce(t("order.updated_at"), t("order.created_at"),
                      t("customer.updated_at"), t("customer.created_at"))


def dedupe_within(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Optional bounded-state dedup of re-delivered events: the same change
    (store, customer id, order id, event time) seen again within ``delay`` of
    the watermark is dropped.  State is bounded by the watermark; the
    key-based upserts downstream absorb anything older anyway."""
    keyed = (stream.withColumn("_event_time", event_time(stream))
             .withColumn("_cid", F.col("customer.id")).withColumn("_oid", F.col("order.id")))
    return (keyed.withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(["store_id", "_cid", "_oid", "_event_time"])
            .drop("_event_time", "_cid", "_oid"))


def now_utc() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def apply_batch(batch: DataFrame, tables: Tables, as_of, batch_id: int | None = None, stream: str = "frame") -> None:
    """Apply one micro-batch (or any static frame of change events).

    ``stream`` and ``batch_id`` name the batch across replays, so that what it set
    aside is there once; without them a frame is a run of its own."""
    spark = batch.sparkSession
    recover(spark, tables.root)
    run = Run(spark, tables.root, f"{stream}-{uuid.uuid4().hex if batch_id is None else batch_id}")
    batch = batch.persist()
    kept, aside = [batch], [spark.createDataFrame([], QUARANTINE)]
    try:
        if CORRUPT in batch.columns:
            aside.append(batch.filter(F.col(CORRUPT).isNotNull()).select(
                F.lit("events").alias("resource"), "store_id", F.lit(None).cast("string").alias("page"),
                F.lit("unreadable").alias("problem"), F.col(CORRUPT).alias("payload"), X.ts_lit(as_of).alias("quarantined_at")))
            batch = batch.filter(F.col(CORRUPT).isNull())

        def good(part: str, resource: str) -> DataFrame:
            flagged = Q.flag(batch.filter(F.col(part).isNotNull()).select("store_id", F.col(part).alias("p")), resource).persist()
            kept.append(flagged)
            aside.append(Q.quarantine_rows(flagged, resource, as_of))
            return flagged.filter(~F.col("quarantined"))

        # Customer part first
        customers = run.stage("customers", P.flatten_customers(good("customer", "customers"), defaults=False, strict=False)
                              .withColumn("updated_at", F.coalesce("updated_at", X.ts_lit(as_of))), "keep_missing")
        # Then the order part, insert-if-absent with the items of the new orders
        orders = good("order", "orders")
        flat_o = U.latest_per_key(P.flatten_orders(orders, strict=False), ["store_id", "order_id"], ["updated_at"])
        stored = U.touched_rows(spark, tables.path("orders"), "orders", flat_o)
        fresh = run.scratch(U.insert_if_absent(stored, flat_o, ["store_id", "order_id"]))
        U.release(stored)
        lines = Q.flag(P.line_items(orders).join(fresh.select("store_id", "order_id"), ["store_id", "order_id"], "left_semi"),
                       "order_items", "li").persist()
        kept.append(lines)
        aside.append(Q.quarantine_rows(lines, "order_items", as_of, "li"))
        run.stage("order_items", P.flatten_items(lines.filter(~F.col("quarantined")), strict=False).withColumn("updated_at", F.col("created_at")), "insert")
        run.stage("orders", fresh, "insert")
        # The customers of the new orders
        new = None
        touched = fresh.select("store_id", "customer_id")
        if not fresh.isEmpty():
            none = fresh.limit(0)
            changes = R.order_changes(none, fresh)
            if U.table_exists(spark, tables.path("refunds")):
                changes = changes.unionByName(R.refunds_that_move(none, fresh, U.read_or_empty(spark, tables.path("refunds"), "refunds")))
            new = run.stage("customer_rollups", R.updated(run, tables.path("customer_rollups"), changes, None, as_of))
        # a customer that already has orders keeps their count, whatever the shop's record says
        R.stage_derived(run, touched.unionByName(customers.select("store_id", "customer_id")), new, customers, as_of)
        run.stage("quarantine", _all(aside), BY_RUN)
        run.commit()
    finally:
        for df in kept:
            df.unpersist()


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start(spark: SparkSession, source_dir: str, tables: Tables, checkpoint: str, as_of=None,
          available_now: bool = True, dedup_delay: str | None = None) -> StreamingQuery:
    """Run the intake; with ``available_now`` it drains what has landed and
    stops, resuming from the checkpoint next time (T4).  ``dedup_delay``
    turns on the watermark dedup of re-delivered events.  Without ``as_of``
    every batch is judged by the time it runs at."""
    src = read_changes(spark, source_dir)
    if dedup_delay:
        src = dedupe_within(src, dedup_delay)

    def apply(df: DataFrame, batch_id: int) -> None:
        apply_batch(df, tables, as_of or now_utc(), batch_id, stream_id(df.sparkSession, checkpoint))

    w = (src.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


__all__ = ["Tables", "read_changes", "dedupe_within", "apply_batch", "stream_id", "start"]
