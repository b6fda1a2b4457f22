"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  Time zone is pinned so that
# "as_of" arithmetic and ISO parsing never depend on the machine.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the only broadcasts are by measured/estimated size under this bound
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # partial aggregation must stay on: hot keys are combined map-side
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # texts can be long: few rows per batch that goes to a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Target bytes of input per initial shuffle partition.  AQE coalesces
# partitions down at run time but never raises their number, so the initial
# count must be sized for the largest shuffle; at 100 TB, the default of 200
# would give ~500 GB per partition.  A narrow table keeps some 4 million rows in
# 64 MB of Parquet, which as the keys of an aggregate take several hundred MB.
TARGET_PARTITION_BYTES = 64 * 1024 * 1024

# What one task may read: of a file (a partial aggregate holds all keys of its
# split) and of a shuffle that AQE coalesces.  Setting: (Spark's default, ours).
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": ("134217728b", "32MB"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "32MB"),
}


def shuffle_partitions_for(input_bytes: int, cores: int,
                           target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Initial shuffle partition count for jobs over ``input_bytes`` of
    table data: one partition per ``target_bytes``, at least two per core."""
    return max(2 * cores, -(-int(input_bytes) // target_bytes))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path``, from the file system's own summary (no listing in Python)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(hpath).getLength() if fs.exists(hpath) else 0


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Set the initial shuffle partitions for jobs over ``path`` and what a task
    reads (``TASK_BYTES``), unless the session has a value that is neither Spark's
    default nor set here before."""
    ours = "lifetide.shuffle.partitions"
    if spark.conf.get("spark.sql.shuffle.partitions") in ("200", spark.conf.get(ours, "200")):
        n = str(shuffle_partitions_for(input_bytes(spark, path), spark.sparkContext.defaultParallelism))
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set(ours, n)
    for key, (default, size) in TASK_BYTES.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, size)


def build_session(master: str | None = None, app: str = "lifetide",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session configured for the library.

    On a cluster ``master`` is None and the launcher decides; tests pass
    ``local[*]``.  ``shuffle_partitions`` should come from
    ``shuffle_partitions_for(input bytes, cores)`` (AQE coalesces down).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        if not k.startswith("spark.ui."):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session (tests,
    laptops) may fall back to a fresh folder under the temp dir; a cluster
    session without the setting is an error, because a machine-local folder
    does not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="lifetide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
