"""Batch sync of landed pages into the store tables.

Resources are applied in the reference's order -- customers, orders (with their
items), abandoned checkouts, then refunds -- each as set-based jobs over all
stores: read the pages that are new (S1) -> set rows aside that cannot be stored as
they are (K9) -> flatten (P) -> latest row per key, the later arrival winning a tie
(W1) -> upsert by (store_id, id) (K3), with the roll-ups, status and metrics of the
customers concerned (A7, A8, A11) kept by differences.

* Pages are read once.  The ledger of a resource is the checkpoint of a file
  stream over its folder; a sync that finds nothing new opens no page, and one
  that follows a crash goes on with the batch that was not done.
* All or nothing (K2): what a batch changes in any table is one run, staged
  together and then published; a sealed run that a failure left is published first.
* A failing store fails alone (K9): a store whose folder cannot be listed, or
  whose pages cannot be read, gets a status row with the error; its pages are held and tried again by the next sync.
* A resource that fails otherwise stops the sync (later ones depend on it).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators import flatten as P
from lifetide.operators import quality as Q
from lifetide.operators import rollups as R
from lifetide.operators import upsert as U
from lifetide.operators.publish import BY_RUN, WHOLE, Run, read_by_run, recover
from lifetide.schemas import HELD_PAGES, KEYS, LOAD_STATUS, TABLES
from lifetide.sources import incremental as I
from lifetide.sources import landed as L
from lifetide.streaming.changes import Tables

log = logging.getLogger(__name__)

# The order in which resources are synced (order items come with their orders).
ORDER = ["customers", "orders", "abandoned_checkouts", "refunds"]
OPTIONAL = {"refunds"}     # a landing without this folder has none


class UnknownStore(ValueError):
    """A sync was asked for a store that the registry does not list."""


def check_stores(requested: list[str], registry: DataFrame) -> None:
    """Refuse a request that names an unknown store, as a whole."""
    spark = registry.sparkSession
    wanted = spark.createDataFrame([(1, s) for s in requested], "request_id int, store_id string")
    refused = [r["store_id"] for r in Q.unknown_stores(wanted, registry).filter("not known").collect()]
    if refused:
        raise UnknownStore(f"unknown stores: {', '.join(sorted(refused))}")


def _rows(resource: str, flagged: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows to load from the good rows of ``flagged``, and what makes one the newest of its key."""
    good = flagged.filter(~F.col("quarantined"))
    if resource == "refunds":
        return P.flatten_refunds(good, strict=False), ["processed_at", "created_at"]
    if resource == "order_items":
        return P.flatten_items(good, strict=False).withColumn("updated_at", F.col("created_at")), ["updated_at"]
    if resource == "customers":
        rows = P.flatten_customers(good, strict=False)
    elif resource == "orders":
        rows = P.flatten_orders(good, strict=False)
    else:
        rows = P.abandoned_only(P.flatten_checkouts(good, strict=False))
    return rows.withColumn("updated_at", F.coalesce(F.col("updated_at"), F.col("created_at"))), ["updated_at"]


# which good records are rows of their table
_COUNTED = {
    "orders": lambda: F.coalesce(F.col("p.line_page"), F.lit(0)) == 0,
    "abandoned_checkouts": lambda: F.col("p.completed_at").isNull(),
}


def sync_all(spark: SparkSession, landing: str, tables: Tables, as_of, stores: list[str] | None = None,
             registry: DataFrame | None = None) -> DataFrame:
    """Apply every landed page that is new, in order; returns this run's per-store,
    per-table status (rows loaded, rows quarantined, success, error), read from the
    ``load_status`` table.  ``stores`` restricts the run (other stores' pages stay new); with a ``registry``
    a request that names an unknown store is refused before anything is read."""
    if stores is not None and registry is not None:
        check_stores(stores, registry)
    recover(spark, tables.root)
    for resource in ORDER:
        try:
            if resource in OPTIONAL and not U.table_exists(spark, f"{landing.rstrip('/')}/{resource}"):
                continue
            _sync_resource(spark, landing, tables, resource, as_of, stores)
        except Exception:
            log.error("sync stopped at %s", resource)
            raise
    return status_of(spark, tables, as_of)


def status_of(spark: SparkSession, tables: Tables, as_of=None) -> DataFrame:
    """What the sync of ``as_of`` (or every sync) did, per store and table."""
    rows = read_by_run(spark, tables.root, "load_status", LOAD_STATUS)
    rows = rows if as_of is None else rows.filter(F.col("synced_at") == X.ts_lit(as_of))
    return (rows.groupBy("store_id", "table_name", "synced_at")
            .agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_quarantined").alias("rows_quarantined"),
                 F.bool_and("success").alias("success"), F.max("error").alias("error"))
            .select(*[f.name for f in LOAD_STATUS.fields]))


def last_status(spark: SparkSession, tables: Tables) -> DataFrame:
    """Per store and table, what the last sync that touched them did (A10)."""
    return U.latest_per_key(status_of(spark, tables), ["store_id", "table_name"], ["synced_at"])


def _sync_resource(spark: SparkSession, landing: str, tables: Tables, resource: str, as_of, stores: list[str] | None) -> None:
    found, failing = L.store_folders(spark, landing, resource)
    if stores is not None:
        found, failing = [s for s in found if s in stores], {s: e for s, e in failing.items() if s in stores}
    if failing:
        run = Run(spark, tables.root, f"{resource}-{as_of}-folders")
        run.stage("load_status", _failed(spark, resource, failing, as_of), BY_RUN)
        run.commit()
    held = [r["page"] for r in _held(spark, tables, resource).filter(F.col("store_id").isin(found)).collect()]
    if held:
        _apply_pages(spark, landing, tables, resource, as_of, f"held-{as_of}", held)
    L.new_pages(spark, landing, resource, found, f"{tables.root.rstrip('/')}/_ledger/{resource}",
                lambda name, pages: _apply_pages(spark, landing, tables, resource, as_of, name, pages))


def _held(spark: SparkSession, tables: Tables, resource: str) -> DataFrame:
    path = tables.path(f"held_pages/{resource}")
    return spark.read.schema(HELD_PAGES).parquet(path) if U.table_exists(spark, path) else spark.createDataFrame([], HELD_PAGES)


def _failed(spark: SparkSession, resource: str, failing: dict[str, str], as_of) -> DataFrame:
    """Status rows of stores that could not be read: failures as data."""
    rows = [(s, resource, 0, 0, False, e) for s, e in failing.items()]
    return P.stamp(spark.createDataFrame(rows, "store_id string, table_name string, rows_loaded long, rows_quarantined long, success boolean, error string"),
                   as_of, ("synced_at",))


def _readable(run: Run, landing: str, resource: str, pages: list[str]) -> tuple[DataFrame, dict[str, list[str]], dict[str, str]]:
    """The lines of the pages, read once; the pages held back and the error, by store.

    If the read fails, each store is tried on its own and the failing ones are left out."""
    read = lambda names: L.read_lines(run.spark, landing, resource, names)
    try:
        return run.scratch(read(pages)), {}, {}
    except Exception as whole:  # noqa: BLE001 - which store it was is found out next
        by_store: dict[str, list[str]] = {}
        for page in pages:
            by_store.setdefault(L.store_of_page(run.spark, page), []).append(page)
        held, errors = {}, {}
        for store, names in sorted(by_store.items()):
            try:
                read(names).write.format("noop").mode("overwrite").save()
            except Exception as e:  # noqa: BLE001 - the store's own error
                held[store], errors[store] = names, L._short(e)
        if not errors:
            raise whole
        kept = [p for s, names in by_store.items() if s not in held for p in names]
        empty = run.spark.createDataFrame([], "store_id string, page string, ingest_seq struct<page:string,pos:int>, raw string")
        return (run.scratch(read(kept)) if kept else empty), held, errors


def _apply_pages(spark: SparkSession, landing: str, tables: Tables, resource: str, as_of, name: str, pages: list[str]) -> None:
    """One batch of pages as one run."""
    recover(spark, tables.root)
    run = Run(spark, tables.root, f"{resource}-{name}")
    lines, held, errors = _readable(run, landing, resource, pages)
    # parsed and checked once for the merge, the roll-ups, the quarantine and the status
    flagged = run.scratch(Q.flag(L.parse_lines(lines, resource), resource))
    counted = _COUNTED[resource]() if resource in _COUNTED else None
    aside, status = [Q.quarantine_rows(flagged, resource, as_of)], [Q.load_status(flagged, resource, counted)]
    after = _latest(run, resource, flagged, as_of)
    if resource == "orders":
        # the items of the good orders; each item is checked on its own
        lines = run.scratch(Q.flag(P.line_items(flagged, ~F.col("quarantined")), "order_items", "li"))
        _latest(run, "order_items", lines, as_of)
        aside.append(Q.quarantine_rows(lines, "order_items", as_of, "li"))
        status.append(Q.load_status(lines, "order_items"))
    _roll_up(run, tables, resource, after, as_of)
    rows = _all([P.stamp(s.withColumn("error", F.lit(None).cast("string")), as_of, ("synced_at",)) for s in status])
    if errors:
        rows = rows.unionByName(_failed(spark, resource, errors, as_of))
    run.stage("load_status", rows.select(*[f.name for f in LOAD_STATUS.fields]), BY_RUN)
    run.stage("quarantine", _all(aside), BY_RUN)
    _hold(run, tables, resource, pages, held, errors, as_of)
    run.commit()


def _hold(run: Run, tables: Tables, resource: str, pages: list[str], held: dict[str, list[str]], errors: dict[str, str], as_of) -> None:
    """Stage the pages to try again: those held before, but for the ones read now, and those that failed now."""
    before = _held(run.spark, tables, resource)
    done = run.spark.createDataFrame([(p,) for p in pages], "page string")
    rows = [(s, p, errors[s]) for s, names in held.items() for p in names]
    failed = P.stamp(run.spark.createDataFrame(rows, "store_id string, page string, error string"), as_of, ("since",))
    left = before.join(done, "page", "left_anti").select(*[f.name for f in HELD_PAGES.fields]).unionByName(failed)
    if held or not before.isEmpty():
        run.stage(f"held_pages/{resource}", left, WHOLE)


def _latest(run: Run, resource: str, flagged: DataFrame, as_of) -> DataFrame:
    """Stage the latest good row per key of ``flagged`` for its table."""
    rows, newest = _rows(resource, flagged)
    keys = ["store_id", KEYS[resource]]
    one = U.latest_per_key(P.stamp(rows, as_of), keys, [*newest, "ingest_seq"], drop=["ingest_seq"])
    return run.stage(resource, one, newest_first="ingestion_timestamp")


def _roll_up(run: Run, tables: Tables, resource: str, after: DataFrame, as_of) -> None:
    """Stage the roll-ups, status and metrics of the customers that ``after`` concerns."""
    if after.isEmpty():
        return
    spark = run.spark
    stored = lambda name: U.read_or_empty(spark, tables.path(name), name)
    path, keys = tables.path("customer_rollups"), ["store_id", "customer_id"]
    if resource == "customers":
        R.stage_derived(run, after, None, after, as_of)
        return
    there = U.touched_rows(spark, tables.path(resource), resource, after)
    before = run.scratch(there.select(*[c for c in after.columns if c in there.columns]))
    U.release(there)
    later = None
    if resource == "orders":
        changes = R.order_changes(before, after)
        if U.table_exists(spark, tables.path("refunds")):
            changes = changes.unionByName(R.refunds_that_move(before, after, stored("refunds")))
        later = R.replaced(stored("orders"), after.select(*keys, "order_id", "created_at"), "order_id")
    elif resource == "refunds":
        orders = U.touched_rows(spark, tables.path("orders"), "orders", before.select("store_id", "order_id").unionByName(after.select("store_id", "order_id")))
        changes = R.refund_changes(before, after, orders)
    else:
        changes = R.checkout_changes(before, after)
    changes = run.scratch(changes)
    if resource == "refunds":
        U.release(orders)
    if changes.isEmpty():
        return
    new = run.stage("customer_rollups", R.updated(run, path, changes, later, as_of))
    R.stage_derived(run, changes, new, None, as_of)


def rebuild_rollups(spark: SparkSession, tables: Tables, as_of) -> None:
    """All roll-ups from the stored orders, checkouts and refunds at once (a table that is older than its roll-ups, or a repair)."""
    recover(spark, tables.root)
    run = Run(spark, tables.root, f"rebuild-{as_of}")
    orders, checkouts, refunds = (U.read_or_empty(spark, tables.path(n), n) for n in ("orders", "abandoned_checkouts", "refunds"))
    changes = (R.order_changes(orders.limit(0), orders).unionByName(R.checkout_changes(checkouts.limit(0), checkouts))
               .unionByName(R.refund_changes(refunds.limit(0), refunds, orders)))
    # roll-ups that nothing adds up to any more become zero
    known = U.read_or_empty(spark, tables.path("customer_rollups"), "customer_rollups").select("store_id", "customer_id")
    new = R.per_customer(changes.unionByName(R._shaped(known))).select(
        "store_id", "customer_id", *[F.col(f"d_{c}").alias(c) for c in R.SUMS], F.col("first_in").alias("first_order_date"),
        F.col("last_in").alias("last_order_date"), X.ts_lit(as_of).alias("updated_at"), (F.col("d_n_orders") == 0).alias("emptied"))
    new = run.stage("customer_rollups", new)
    everyone = U.read_or_empty(spark, tables.path("customers"), "customers").select("store_id", "customer_id")
    R.stage_derived(run, everyone, new, None, as_of)
    run.commit()


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def sync_exports(spark: SparkSession, exports: str, tables: Tables, as_of, days: int = X.DEFAULT_LOOKBACK_DAYS) -> dict[str, int]:
    """Take over what is new in exported tables (S2, S3, A14): ``<exports>/<resource>.parquet`` with the canonical columns and numeric ids.

    The stored marks and the lookback window bound the scan; a late change inside
    the window is taken, an unchanged row is not.  The rows, the roll-ups and the moved marks are one run.
    Returns rows taken by resource."""
    recover(spark, tables.root)
    taken = {}
    for resource in ORDER:
        path, key = f"{exports.rstrip('/')}/{resource}.parquet", KEYS[resource]
        if not U.table_exists(spark, path):
            continue
        run = Run(spark, tables.root, f"export-{resource}-{as_of}")
        marks = I.read_marks(spark, tables.root, resource)
        read = run.scratch(I.read_window(spark.read.parquet(path), marks, key, as_of, days))
        batch = U.conform(read, resource)
        stored = U.touched_rows(spark, tables.path(resource), resource, batch)
        fresh = run.scratch(U.latest_per_key(I.changed_only(batch, stored, ["store_id", key]), ["store_id", key], ["updated_at"])
                            if "updated_at" in batch.columns else U.insert_if_absent(stored, batch.dropDuplicates(["store_id", key]), ["store_id", key]))
        U.release(stored)
        taken[resource] = fresh.count()
        after = run.stage(resource, P.stamp(fresh, as_of), newest_first="ingestion_timestamp")
        _roll_up(run, tables, resource, after, as_of)
        moved = I.advance(marks, read, key).select("store_id", F.col("since_id").cast("long").alias("since_id"))
        run.stage(f"marks/resource={resource}", moved, WHOLE)
        run.commit()
    return taken


def customer_metrics_rows(profile: DataFrame, as_of) -> DataFrame:
    """A profile as rows of the customer_metrics table (without predictions)."""
    return (profile.withColumn("refund_rate", X.guarded_ratio("total_refunded", "total_spent"))
            .withColumn("updated_at", X.ts_lit(as_of)))


def store_predictions(spark: SparkSession, tables: Tables, predictions: DataFrame) -> None:
    """Put predicted CLV, confidence and prediction date beside the stored metrics (M3)."""
    rows = predictions.select("store_id", "customer_id", "predicted_clv", "clv_confidence_score", "last_prediction_date",
                              F.col("last_prediction_date").alias("updated_at"))
    U.upsert_table(spark, tables.path("customer_metrics"), "customer_metrics", rows, newest_first=["updated_at"])


def create_catalog(spark: SparkSession, tables: Tables, database: str) -> None:
    """Create every table of the model and name it in the catalog (K7, V2)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in TABLES.items():
        U.create_table(spark, tables.path(name), name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}, `{U.KEY_BUCKET}` int) USING parquet "
                  f"PARTITIONED BY ({', '.join(U.PARTITIONS)}) LOCATION '{tables.path(name)}'")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`returns` AS {RETURNS.format(refunds=f'`{database}`.`refunds`')}")


# The view of refunds under the names of returns.
RETURNS = ("SELECT refund_id AS return_id, store_id, order_id, customer_id, status, created_at AS return_date, processed_at, "
           "amount AS refund_amount, currency, reason, note FROM {refunds}")
