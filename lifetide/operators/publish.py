"""All or nothing: what one run writes is staged together, then published.

A run is one batch of one stream, or one batch of one resource of a sync; its id
names it across replays.  It stages the rows of every table it is going to change,
and is sealed.  Until then nothing has changed, and what was staged goes.  From
then on it is published, at once or, after a failure, by the next writer before it
reads anything (``recover``): every part is applied by key, or replaces what the
same run wrote, so publishing again gives the same tables.

One writer at a time, as for every merge of these tables.  Staged parts are plain
Parquet folders under ``<root>/_staged``; they go once published, so there is no
history here.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.operators import upsert as U

PART = "n int, table string, mode string, newest_first string"
#: tables that are added to by run: what a run wrote before is replaced
BY_RUN = "run"
#: small tables that are written whole
WHOLE = "replace"


def path_safe(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9_-]+", "-", text)


class Run:
    """The writes of one run."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), path_safe(run_id)
        self.folder = f"{self.root}/_staged/{self.run_id}"
        self.parts: list[tuple[int, str, str, str]] = []
        _delete(spark, self.folder)

    def stage(self, table: str, rows: DataFrame, mode: str = "upsert", newest_first: str = "updated_at") -> DataFrame:
        """Stage ``rows`` for ``table``; returns them as staged.  ``mode``: one of ``upsert_table``, ``BY_RUN`` or ``WHOLE``."""
        n = len(self.parts)
        path = f"{self.folder}/{n}-{table}"
        rows.write.parquet(path)
        self.parts.append((n, table, mode, newest_first))
        return self.spark.read.schema(rows.schema).parquet(path)

    def scratch(self, rows: DataFrame) -> DataFrame:
        """``rows`` written beside the parts and read back; goes with them."""
        self.n_scratch = getattr(self, "n_scratch", 0) + 1
        path = f"{self.folder}/scratch-{self.n_scratch}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def seal(self) -> None:
        """From here on the run counts as done."""
        self.spark.createDataFrame(self.parts, PART).coalesce(1).write.json(f"{self.folder}/sealed")

    def publish(self) -> None:
        for n, table, mode, newest in self.parts:
            rows = self.spark.read.parquet(f"{self.folder}/{n}-{table}")
            path = f"{self.root}/{table}"
            if mode == BY_RUN:
                _replace(rows, f"{path}/run_id={self.run_id}")
            elif mode == WHOLE:
                rows.coalesce(1).write.mode("overwrite").parquet(path)
            elif not rows.isEmpty():
                U.upsert_table(self.spark, path, table, rows, mode=mode, newest_first=[newest])
        _delete(self.spark, self.folder)

    def commit(self) -> None:
        self.seal()
        self.publish()


def _replace(rows: DataFrame, path: str) -> None:
    if rows.isEmpty():
        _delete(rows.sparkSession, path)
    else:
        U.by_folder(rows, ["resource"] if "resource" in rows.columns else ["store_id"]).write.mode("overwrite").parquet(path)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Publish the sealed runs that a failure left, drop the others; the ids of those published."""
    base = f"{root.rstrip('/')}/_staged"
    if not U.table_exists(spark, base):
        return []
    fs, path = _fs(spark, base)
    done = []
    for status in fs.listStatus(path):
        run_id = status.getPath().getName()
        folder = f"{base}/{run_id}"
        if U.table_exists(spark, f"{folder}/sealed/_SUCCESS"):
            run = Run.__new__(Run)
            run.spark, run.root, run.run_id, run.folder = spark, root.rstrip("/"), run_id, folder
            run.parts = [tuple(r) for r in spark.read.schema(PART).json(f"{folder}/sealed").orderBy("n").collect()]
            run.publish()
            done.append(run_id)
        else:
            fs.delete(status.getPath(), True)
    return done


def read_by_run(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """All rows of a table that is added to by run, with their ``run_id``."""
    from pyspark.sql import types as T
    path = f"{root.rstrip('/')}/{table}"
    whole = T.StructType([*schema.fields, T.StructField("run_id", T.StringType(), True)])
    if not U.table_exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path).select(*[F.col(f.name) for f in whole.fields])


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)
