"""Data-quality checks on the data itself.

The reference only lists declared keys; here keys are checked on the rows:
duplicate primary keys, orphan foreign keys, unknown stores, quarantined
rows per store.  Every check is one aggregate or anti-join over whole tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.errors import PySparkTypeError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from lifetide.functions import scalars as X


def pk_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Keys that occur more than once: table_name, key, n_rows (V3).
    Counting is a partial aggregate, so a hot key costs one row per task."""
    parts = []
    for name, (df, keys) in tables.items():
        # grouped by the columns themselves (a NULL part is a value of its
        # own); the text is built for the few keys that repeat
        text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        parts.append(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
                     .filter(F.col("n_rows") > 1)
                     .select(F.lit(name).alias("table_name"), text.alias("key"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def fk_orphans(checks: dict[str, tuple[DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """Rows whose foreign key has no parent, per relation (V4).
    A NULL foreign key is legal (e.g. a guest checkout) and not counted."""
    parts = []
    for name, (child, parent, keys) in checks.items():
        c = child.select(*keys)
        for k in keys:
            c = c.filter(F.col(k).isNotNull())
        # rows per foreign key first (partial aggregate: a hot key is one row
        # per task), then the anti join runs on distinct keys only
        per_key = c.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        orphans = per_key.join(parent.select(*keys).distinct(), keys, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphans"))
                     .select(F.lit(name).alias("relation"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


def unknown_stores(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requested stores checked against the registry (F6): a request naming
    any unknown store is refused as a whole, every store in it marked not
    accepted.  Columns: request_id, store_id, known, accepted."""
    known = registry.select("store_id").distinct().withColumn("known", F.lit(True))
    r = (requests.join(known, "store_id", "left")
         .withColumn("known", F.coalesce(F.col("known"), F.lit(False))))
    verdict = r.groupBy("request_id").agg(F.min(F.col("known").cast("int")).alias("_all"))
    return (r.join(verdict, "request_id")
            .select("request_id", "store_id", "known", (F.col("_all") == 1).alias("accepted")))


# The money and time fields of every payload.
MONEY_FIELDS = {
    "customers": ("total_spent",),
    "orders": ("total_price", "subtotal_price", "total_tax", "total_discounts"),
    "order_items": ("price", "total_discount"),
    "abandoned_checkouts": ("total_price", "subtotal_price", "total_tax", "total_discounts"),
    "refunds": ("amount",),
}
TIME_FIELDS = {
    "customers": ("created_at", "updated_at"),
    "orders": ("created_at", "updated_at", "cancelled_at", "closed_at", "processed_at"),
    "order_items": (),
    "abandoned_checkouts": ("created_at", "updated_at", "completed_at"),
    "refunds": ("created_at", "processed_at"),
}


def _checks(record: Column, resource: str) -> list[tuple[Column, str]]:
    """What can be wrong with a record (a struct), and the name of the problem."""
    # text that cannot be parsed gives a record of NULLs (PERMISSIVE mode)
    unreadable = record.isNull() | (record["id"].isNull() & (F.to_json(record) == "{}"))
    checks = [(unreadable, "unreadable"), (~unreadable & record["id"].isNull(), "id")]
    checks += [(~X.money_is_valid(record[f]), f) for f in MONEY_FIELDS[resource]]
    return checks + [(record[f].isNotNull() & X.iso_utc(record[f]).isNull(), f) for f in TIME_FIELDS[resource]]


def flag(parsed: DataFrame, resource: str, root: str = "p") -> DataFrame:
    """Add ``problem`` and ``quarantined`` (K9): an unreadable record, a missing
    id, junk money or an unreadable time in any field that is stored.  Such a
    row is set aside instead of failing the job or losing the field.

    A filter on ``quarantined`` right after a parse makes the optimizer copy every
    check, and the parse with it, into the filter; keep the flag as a column up to an aggregate or a write, or use ``line_items(where=)``."""
    text = F.concat_ws(",", *[F.when(bad, F.lit(name)) for bad, name in _checks(F.col(root), resource)])
    return (parsed.withColumn("problem", text).withColumn("quarantined", F.col("problem") != "")
            .withColumn("problem", F.when(F.col("quarantined"), F.col("problem"))))


def is_bad(record: Column, resource: str) -> Column:
    """Whether a record (a struct, say an element of an array) has any problem."""
    bad = [F.coalesce(c, F.lit(False)) for c, _ in _checks(record, resource)]
    return reduce(lambda a, b: a | b, bad)


def load_status(flagged: DataFrame, table_name: str, counted=None) -> DataFrame:
    """Per store: rows loaded into the table, rows quarantined, success (no
    quarantined row) -- one aggregate over the flagged rows, all stores in one
    job (K9).  ``counted``: which good rows the table stores (default: all)."""
    q = F.col("quarantined")
    good = ~q if counted is None else ~q & F.coalesce(counted, F.lit(False))
    return (flagged.groupBy("store_id")
            .agg(F.count_if(good).alias("rows_loaded"), F.count_if(q).alias("rows_quarantined"))
            .select("store_id", F.lit(table_name).alias("table_name"), "rows_loaded", "rows_quarantined",
                    (F.col("rows_quarantined") == 0).alias("success")))


def quarantine_rows(flagged: DataFrame, resource: str, as_of, root: str = "p") -> DataFrame:
    """The rows set aside, in the form of the quarantine table (the record's own text, or the parsed record's)."""
    page = F.col("page") if "page" in flagged.columns else F.lit(None).cast("string")
    text = F.to_json(root)
    text = F.coalesce(F.col("raw"), text) if "raw" in flagged.columns else text
    return flagged.filter("quarantined").select(
        F.lit(resource).alias("resource"), "store_id", page.alias("page"), "problem", text.alias("payload"),
        X.ts_lit(as_of).alias("quarantined_at"))


def column_listing(df: DataFrame, spark: SparkSession, expected: T.StructType | None = None, counted: bool = False) -> DataFrame:
    """Column listing of a table (V1): name, type, nullable, and whether the
    canonical schema declares it.  Built from schema metadata only, unless
    ``counted``: then also ``n_values``, the rows that hold a value, from one aggregate."""
    exp = {f.name: f.dataType.simpleString() for f in expected.fields} if expected else {}
    rows = [(f.name, f.dataType.simpleString(), f.nullable,
             (exp.get(f.name) == f.dataType.simpleString()) if expected else None)
            for f in df.schema.fields]
    if not counted:
        schema = "column_name string, data_type string, nullable boolean, matches_canonical boolean"
        return spark.createDataFrame(rows, schema)
    names = ("column_name", "data_type", "nullable", "matches_canonical")
    listed = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)], F.col(f"_{i}").alias("n_values")) for i, row in enumerate(rows)]
    counts = df.agg(*[F.count(F.col(f"`{row[0]}`")).alias(f"_{i}") for i, row in enumerate(rows)])
    return counts.select(F.explode(F.array(*listed)).alias("c")).select("c.*")


def footer_drift(spark: SparkSession, path: str, expected: T.StructType) -> DataFrame:
    """Where the Parquet files under ``path`` depart from the canonical types (V1, V2):
    file, column_name, found_type, expected_type, problem.

    ``problem``: ``type`` (another type than declared), ``missing`` (no such column; the
    folder's ``name=value`` parts count as columns), ``extra`` (not declared) or
    ``unreadable`` (no footer; no column).  A folder whose files all agree gives no row.
    Spark lists the files without opening them; the tasks read each file's footer only,
    so the work grows with the number of files, not their size.  Column names compare as
    written.  Paths: local, or of a store that pyarrow can open."""
    declared = {f.name: f.dataType.simpleString() for f in expected.fields}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row for uri in batch.column(0).to_pylist() for row in _departures(uri, declared)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.string()) for i in range(5)], names=names)

    names = ["file", "column_name", "found_type", "expected_type", "problem"]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))
    return files.mapInArrow(read, ", ".join(f"{n} string" for n in names))


def _departures(uri: str, declared: dict[str, str]) -> list[tuple]:
    """The departures of one file, from its footer."""
    try:
        store, inside = fs.FileSystem.from_uri(uri)
        with store.open_input_file(inside) as f:
            footer = pq.read_schema(f)
        found = {f.name: f.dataType.simpleString() for f in from_arrow_schema(footer, prefer_timestamp_ntz=True).fields}
    except (OSError, ValueError, TypeError, PySparkTypeError):   # no Parquet, or of a type that Spark cannot read
        return [(uri, None, None, None, "unreadable")]
    folders = {part.split("=", 1)[0] for part in uri.split("/")[:-1] if "=" in part}
    out = [(uri, c, t, declared.get(c), "type" if c in declared else "extra") for c, t in found.items() if declared.get(c) != t]
    return out + [(uri, c, None, t, "missing") for c, t in declared.items() if c not in found and c not in folders]


def tables_present(spark: SparkSession, expected: list[str], database: str | None = None) -> DataFrame:
    """Expected table names flagged present/absent in the catalog (V2, F5);
    names compare case-insensitively."""
    found = [t.name.lower() for t in spark.catalog.listTables(database)]
    e = spark.createDataFrame([(n.lower(),) for n in expected], "table_name string")
    return e.select("table_name", F.col("table_name").isin(found).alias("present")).orderBy("table_name")


def compare_names(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Every expected name once, in order, with whether it was found; names
    compare case-insensitively (V2, F5, U2, O4)."""
    seen = found.select(F.lower("name").alias("name")).distinct().withColumn("present", F.lit(True))
    return (expected.select(F.lower("name").alias("name")).distinct().join(seen, "name", "left")
            .select("name", F.coalesce("present", F.lit(False)).alias("present")).orderBy("name"))


def missing_tables(spark: SparkSession, expected: list[str], found: list[str]) -> DataFrame:
    """Expected tables not found, compared case-insensitively."""
    e = spark.createDataFrame([(n.lower(),) for n in expected], "table_name string")
    f = spark.createDataFrame([(n.lower(),) for n in found], "table_name string")
    return e.exceptAll(f).orderBy("table_name")
