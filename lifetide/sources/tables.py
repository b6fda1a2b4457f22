"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<base>/<name>.parquet`` (a file or a folder of part files), as it is now.

    Only ``columns`` are kept, so the scan's ReadSchema is pruned to them
    and filters placed above push into the Parquet reader.
    """
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df
