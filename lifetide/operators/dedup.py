"""Latest row per key (W1) and last arrival per key.

Both are a grouped ``max`` over one struct -- (ordering..., row values) --
instead of ``row_number()`` over a window.  The aggregate is combined
map-side (partial aggregation), so a key that holds a third of all rows is
reduced inside every map task before the shuffle; a window would send all
of that key's rows to one task and sort them there.  Struct comparison is
field by field with NULL lowest, which gives "newest first, NULLS LAST",
and the row values in the struct break any remaining tie deterministically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list, drop: list[str] = ()) -> DataFrame:
    """One row per key: the row that is greatest by ``newest_first``
    (columns or expressions compared in order, NULL oldest).

    ``drop`` names columns used only for ordering (e.g. an arrival
    sequence); they are not returned.
    """
    values = [c for c in df.columns if c not in keys]
    order = F.struct(*[_col(c).alias(f"_o{i}") for i, c in enumerate(newest_first)])
    best = F.max(F.struct(order.alias("o"), F.struct(*values).alias("v"))).alias("best")
    out = df.groupBy(*keys).agg(best).select(*keys, "best.v.*")
    return out.drop(*drop) if drop else out


def latest_non_null_per_key(df: DataFrame, keys: list[str], newest_first: list,
                            drop: list[str] = ()) -> DataFrame:
    """Per key and per column, the newest non-NULL value (K6, T1): the result
    of applying a batch of partial updates in order.  A column NULL in every
    row of the key stays NULL.  Per column this is ``max`` over
    (ordering, value), NULL when the value is missing; ``max`` skips NULLs,
    so it picks the newest present value, and the value itself breaks a tie
    in the ordering deterministically (``max_by`` would pick an arbitrary
    row).  Map columns are not comparable and fall back to ``max_by``.  The
    aggregate is combined map-side like W1."""
    order = F.struct(*[_col(c).alias(f"_o{i}") for i, c in enumerate(newest_first)])
    values = [c for c in df.columns if c not in keys and c not in drop]

    def newest(c: str) -> Column:
        present = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, T.MapType):
            return F.max_by(F.col(c), F.when(present, order))
        return F.max(F.when(present, F.struct(order.alias("o"), F.col(c).alias("v")))).getField("v")

    return df.groupBy(*keys).agg(*[newest(c).alias(c) for c in values])


def dedup_keep_last(df: DataFrame, keys: list[str], arrival_seq: str, drop_seq: bool = False) -> DataFrame:
    """Drop duplicate keys keeping the last arrival (W2): ordered by the
    arrival sequence only, even when an earlier arrival is newer by time.
    (``dropDuplicates`` is not this: it keeps an arbitrary row.)"""
    return latest_per_key(df, keys, [arrival_seq], drop=[arrival_seq] if drop_seq else [])


def latest_by_updated(df: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """W1 with the reference's ordering column choice: ``updated_at``, else
    ``created_at``, else the first non-key column; then the arrival sequence."""
    if "updated_at" in df.columns:
        ts = "updated_at"
    elif "created_at" in df.columns:
        ts = "created_at"
    else:
        ts = next(c for c in df.columns if c not in keys)
    order = [ts] + ([seq] if seq else [])
    return latest_per_key(df, keys, order, drop=[seq] if seq else [])
