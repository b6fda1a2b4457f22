"""Join helpers: tenant-aware keys and NULL-key isolation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys_for(left: DataFrame, right: DataFrame, id_col: str) -> list[str]:
    """Join keys for an id column: (store_id, id) when both sides carry a
    store, else the id alone.  Ids of different stores may collide, so the
    store takes part whenever it can."""
    if "store_id" in left.columns and "store_id" in right.columns:
        return ["store_id", id_col]
    return [id_col]


def left_join_nullsafe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """LEFT join that keeps rows with a NULL key out of the shuffle.

    Rows whose key has a NULL can never match, but a hash exchange sends them
    all to one task (e.g. every guest checkout).  They bypass the join and are
    padded with NULLs instead.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    keyed = left.filter(~any_null)
    unkeyed = left.filter(any_null)
    joined = keyed.join(right, on, "left")
    extra = [F.lit(None).cast(right.schema[c].dataType).alias(c)
             for c in right.columns if c not in on]
    return joined.unionByName(unkeyed.select(*left.columns, *extra))
