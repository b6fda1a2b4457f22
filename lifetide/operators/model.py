"""Predicted CLV (M1-M4).

The seven features of ``metrics.FEATURES`` are standardised on the training
rows only and fed to boosted trees that grow leaf by leaf
(``operators.boosting``).  Training, scoring and the train/validation split
are all distributed; the split is a hash of the customer key, so it does not
move when the data is repartitioned.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.functions import scalars as X
from lifetide.operators import boosting
from lifetide.operators import metrics as M

# The reference's training settings.
SEED = 42
TRAIN_SHARE = 8            # of 10 hash buckets
SETTINGS = boosting.Settings(leaves=31, rate=0.05, feature_share=0.9, rounds=100, patience=10, seed=SEED)


def split_flag(df: DataFrame) -> DataFrame:
    """``is_validation``: stable 80/20 split by a digest of the customer key
    (one that any engine can compute)."""
    digest = F.md5(F.concat_ws("|", "store_id", "customer_id", F.lit(str(SEED))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10
    return df.withColumn("is_validation", bucket >= TRAIN_SHARE)


class Untrained(ValueError):
    """Scoring was asked of a model that was never fitted."""


def training_frame(customers: DataFrame, orders: DataFrame, abandoned: DataFrame,
                   refunds: DataFrame, cutoff, horizon_days: int) -> DataFrame:
    """Features as of ``cutoff`` (only history before it) and the target:
    spend in the ``horizon_days`` after the cutoff.  No future data leaks
    into the features."""
    cut = X.ts_lit(cutoff)
    end = cut + F.make_dt_interval(F.lit(horizon_days))
    past_orders, past_ck, past_rf = history(cutoff, orders, abandoned, refunds)
    prof = M.clv_profile(customers, past_orders, past_ck, past_rf)
    feats = M.clv_features(prof, cutoff)
    target = (orders.filter((F.col("created_at") >= cut) & (F.col("created_at") < end))
              .groupBy("store_id", "customer_id").agg(F.sum("total_price").alias("_t")))
    return (feats.join(target, ["store_id", "customer_id"], "left")
            .withColumn("label", F.coalesce(F.col("_t"), F.lit(0)).cast("double")).drop("_t"))


def train(frame: DataFrame) -> boosting.Model:
    """Fit on the 80% share; the 20% share drives early stopping.
    The features are standardised on the training share only (M2)."""
    flagged = split_flag(frame).select(*M.FEATURES, "label", "is_validation").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return boosting.fit(flagged, M.FEATURES, settings=SETTINGS)
    finally:
        flagged.unpersist()


def history(as_of, *tables: DataFrame) -> list[DataFrame]:
    """Each table's rows before ``as_of``: what was known then."""
    return [df.filter(F.col("created_at") < X.ts_lit(as_of)) for df in tables]


def predict(model: boosting.Model | None, profile: DataFrame, as_of) -> DataFrame:
    """Predicted CLV, confidence, prediction date, features used (M3, M4).
    ``profile``: as of ``as_of``, see ``history``; features and confidence come from one pass over it."""
    if model is None:
        raise Untrained("no trained model: call train() first")
    confidence = X.confidence("total_orders", "first_order_date", "last_order_date", as_of)
    scored = model.transform(M.clv_features(profile.withColumn("clv_confidence_score", confidence), as_of, keep=("clv_confidence_score",)))
    return (scored.select("store_id", "customer_id", "predicted_clv", "clv_confidence_score")
            .withColumn("last_prediction_date", X.ts_lit(as_of))
            .withColumn("features_used", F.array(*[F.lit(f) for f in M.FEATURES])))


def rmse(model: boosting.Model, frame: DataFrame) -> float:
    """Root mean squared error on a frame (one small aggregate)."""
    out = model.transform(frame).agg(
        F.sqrt(F.avg((F.col("predicted_clv") - F.col("label")) ** 2)).alias("rmse")).first()
    return float(out["rmse"])
