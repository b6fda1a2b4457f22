"""Landed API pages (S1): JSON files written page by page per store.

Layout: ``<root>/<resource>/store_id=<store>/<page files>``.  Each line of a
page file is one resource object.  The reader applies the explicit payload
schema (no inference), takes ``store_id`` from the folder (partition
discovery), and keeps the page file name and line position as the arrival
sequence, so "last arrival wins" (W2) has a deterministic meaning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.schemas import CHECKOUT_PAYLOAD, CUSTOMER_PAYLOAD, ORDER_PAYLOAD, REFUND_PAYLOAD

PAYLOADS = {
    "customers": CUSTOMER_PAYLOAD,
    "orders": ORDER_PAYLOAD,
    "abandoned_checkouts": CHECKOUT_PAYLOAD,
    "refunds": REFUND_PAYLOAD,
}


PAGE_ROWS = 250            # rows of one landed page


def read_lines(spark: SparkSession, root: str, resource: str, pages: list[str] | None = None) -> DataFrame:
    """Lines of landed pages (all, or those named): store_id, page (file), ingest_seq (page file, position in it), raw (text).

    A page file is read as one value and cut into lines, so a record's position
    does not depend on how files are split; pages are small (the API's page size)
    and read in parallel.
    """
    base = f"{root.rstrip('/')}/{resource}"
    text = spark.read.option("basePath", base).option("wholetext", True).text(pages if pages is not None else f"{base}/store_id=*")
    lines = text.select(F.col("store_id").cast("string").alias("store_id"), F.input_file_name().alias("page"),
                        F.posexplode(F.split("value", "\r?\n")).alias("pos", "raw"))
    return lines.filter(F.trim("raw") != "").select("store_id", "page", F.struct("page", "pos").alias("ingest_seq"), "raw")


def parse_lines(lines: DataFrame, resource: str) -> DataFrame:
    """``lines`` with the parsed record ``p``.  Malformed lines give a NULL ``p`` (PERMISSIVE), for the quarantine step."""
    return lines.withColumn("p", F.from_json("raw", PAYLOADS[resource]))


def read_pages(spark: SparkSession, root: str, resource: str) -> DataFrame:
    """All landed pages of one resource for all stores, parsed into ``p``."""
    return parse_lines(read_lines(spark, root, resource), resource)


def store_of_page(spark: SparkSession, page: str) -> str:
    """The store in whose folder a page lies."""
    name = page.split("/store_id=")[-1].split("/")[0]
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def store_folders(spark: SparkSession, root: str, resource: str) -> tuple[list[str], dict[str, str]]:
    """Stores that have landed pages of a resource, and those whose folder cannot be listed, with the error (metadata only)."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{resource}")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stores, failing = [], {}
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("store_id="):
            store = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.removeprefix("store_id="))
            try:
                fs.listStatus(status.getPath())
                stores.append(store)
            except Exception as e:  # noqa: BLE001 - whatever the file system says is the store's error
                failing[store] = _short(e)
    return sorted(stores), failing


def _short(e: Exception) -> str:
    text = str(getattr(e, "java_exception", None) or e)
    return text.strip().split("\n")[0][:500]


def new_pages(spark: SparkSession, root: str, resource: str, stores: list[str], ledger: str, each: Callable[[str, list[str]], None],
              at_once: int = 20_000) -> None:
    """Call ``each(batch name, page paths)`` for landed pages not seen before, at most ``at_once`` at a time.

    A file stream that runs until it has caught up; its checkpoint (``ledger``) is the
    record of pages done.  It names pages and opens none.  A batch whose call failed is named again by the next run,
    under the same name."""
    if not stores:
        return
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    base = f"{root.rstrip('/')}/{resource}"
    glob = "{" + ",".join(_literal(f"store_id={escape(s)}") for s in stores) + "}"
    named = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             # every page counts, however old it is beside the newest
             .option("basePath", base).option("maxFileAge", "365000d").option("maxFilesPerTrigger", at_once).load(f"{base}/{glob}").select("path"))

    def one(df: DataFrame, batch_id: int) -> None:
        from lifetide.streaming.changes import stream_id
        each(f"{stream_id(df.sparkSession, ledger)}-{batch_id}", [r["path"] for r in df.collect()])

    query = named.writeStream.foreachBatch(one).option("checkpointLocation", ledger).trigger(availableNow=True).start()
    query.awaitTermination()


def _literal(name: str) -> str:
    """``name`` in a path pattern."""
    return "".join("\\" + c if c in "{}[]*?,\\" else c for c in name)


def land_pages(df: DataFrame, root: str, resource: str, page_rows: int = PAGE_ROWS) -> None:
    """Write ``(store_id, payload)`` rows as landed page files (tests, replays)."""
    (df.select("store_id", F.col("payload").alias("value"))
     .write.mode("append").option("maxRecordsPerFile", page_rows).partitionBy("store_id").text(f"{root.rstrip('/')}/{resource}"))


__all__ = ["read_pages", "read_lines", "parse_lines", "store_folders", "new_pages", "land_pages"]
