"""Mixing sources to target weights by capped water-filling (operator 10, native).

Every source wants ``weight / sum of weights`` of all words.  A source whose
share exceeds ``max_epochs`` times its own words is clamped there; the excess
goes to the other sources in proportion to their weights, until none is above
its cap.  The clamped set is a prefix of the sources ordered by cap / weight,
so one running sum over the source table (one row per source) finds the level.

A source's target is then ``epochs`` copies of its words.  Every document is
taken ``floor(epochs)`` whole times.  The remaining words come from one more,
seeded pass: documents in random but repeatable order, whole repetitions until
the target is met, and one fractional repetition (some of its words) at the
end.  The running sum of that order is split into hash buckets, so a source
with a third of all rows is many small windows plus one sum over buckets.

Defined results: null texts have size 0; a null source is a source of its own
and comes last; sources without words get target 0; repeated rows are rows of
their own (equal rows are interchangeable); an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifetide.llm.common import WORD, stage, text_or_empty

WEIGHTS = (5, 2, 1)        # by rank of the source, repeating
MAX_EPOCHS = 3
SEED = 20240607
BUCKET_ROWS = 4096         # rows of one source in a window of the seeded order


def word_count(col: str = "text"):
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source_size, n_docs, target."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = per.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = (ranked
              .withColumn("_w", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]),
                                             (((F.col("_rank") - 1) % len(weights)) + 1).cast("int")))
              .withColumn("_cap", F.col("source_size") * max_epochs)
              .withColumn("_total", F.sum("source_size").over(every))
              .withColumn("_all_w", F.sum("_w").over(every)))
    # sources by cap / weight: what lies before a source is clamped if its own level still overflows
    order = Window.orderBy((F.col("_cap").cast("double") / F.col("_w")), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranked
              .withColumn("_rest", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
              .withColumn("_rest_w", F.col("_all_w") - F.coalesce(F.sum("_w").over(before), F.lit(0)))
              .withColumn("_over", F.col("_cap") * F.col("_rest_w") <= F.col("_rest") * F.col("_w")))
    # the first source that is not clamped fixes the level of all that follow
    level = F.min(F.when(~F.col("_over"), F.struct("_pos", "_rest", "_rest_w"))).over(every)
    ranked = ranked.withColumn("_pos", F.row_number().over(order)).withColumn("_level", level)
    clamped = F.col("_level").isNull() | (F.col("_pos") < F.col("_level._pos"))
    share = (F.col("_level._rest") * F.col("_w")).cast("double") / F.col("_level._rest_w")
    return ranked.select("source", "source_size", "n_docs",
                         F.when(clamped, F.col("_cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, source_size, target (its source's) and taken: words the mix takes of each document."""
    sizes = stage(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    # staged, so that Spark knows its size (one row per source) when it picks the side to broadcast, if any
    targets = stage(source_targets(sizes, weights, max_epochs).withColumnRenamed("source", "_src"), "mix-targets")
    rows = (sizes.join(targets, F.col("source").eqNullSafe(F.col("_src")), "inner").drop("_src")
            .withColumn("_h", F.md5(F.concat(F.lit(f"{int(seed)}:"),
                                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))))
    # buckets are ranges of the order (leading hex digits), about bucket_rows rows each
    digits = F.greatest(F.lit(0), F.ceil(F.log(F.col("n_docs") / F.lit(int(bucket_rows))) / F.log(F.lit(16.0)))).cast("int")
    rows = rows.withColumn("_bucket", F.substring("_h", F.lit(1), digits))
    buckets = stage(words_before(rows), "mix-buckets")
    here = Window.partitionBy("source", "_bucket").orderBy("_h", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(here), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_src")) & (F.col("_bucket") == F.col("_b"))
    rows = (rows.join(buckets, same, "inner")
            .withColumn("_start", F.col("_in") + F.col("_before")))
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = F.round(F.col("target") - whole * F.col("source_size")).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("_start")))
    return rows.select("doc_id", "size", "source_size", "target",
                       (whole * F.col("size") + extra).cast("long").alias("taken"))


def words_before(rows: DataFrame) -> DataFrame:
    """Words of a source's buckets that lie before each bucket: one row per (source, bucket)."""
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
            .select(F.col("source").alias("_src"), F.col("_bucket").alias("_b"),
                    F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before")))
