"""Model properties (M1-M4): beats the mean predictor, deterministic, valid output."""

import pytest
from pyspark.sql import functions as F

from lifetide.operators import metrics as M
from lifetide.operators import model as ML
from lifetide.sources.bridge import Bridge

from conftest import SF_ORACLE

CUTOFF = "2000-08-02 00:00:00"


@pytest.fixture(scope="module")
def frame(spark):
    b = Bridge(spark, SF_ORACLE)
    return ML.training_frame(b.customers(), b.orders(), b.abandoned_checkouts(), b.refunds(),
                             CUTOFF, horizon_days=365).cache()


def test_no_leak_features_before_cutoff(spark, frame):
    assert frame.agg(F.max("days_since_last_order")).first()[0] >= 0
    assert frame.count() == Bridge(spark, SF_ORACLE).customers().count()


def test_split_is_stable(spark, frame):
    a = ML.split_flag(frame).filter("is_validation").select("customer_id").collect()
    b = ML.split_flag(frame.repartition(7)).filter("is_validation").select("customer_id").collect()
    assert sorted(a) == sorted(b) and 0.1 < len(a) / frame.count() < 0.3


def test_train_beats_mean_and_is_deterministic(spark, frame):
    model = ML.train(frame)
    train_rows = ML.split_flag(frame).filter(~F.col("is_validation"))
    mean = train_rows.agg(F.avg("label")).first()[0]
    base = train_rows.agg(F.sqrt(F.avg((F.col("label") - F.lit(mean)) ** 2))).first()[0]
    assert ML.rmse(model, train_rows) < base
    again = ML.train(frame)
    p1 = sorted(r.predicted_clv for r in model.transform(frame).select("predicted_clv").collect())
    p2 = sorted(r.predicted_clv for r in again.transform(frame).select("predicted_clv").collect())
    assert p1 == p2

    b = Bridge(spark, SF_ORACLE)
    prof = M.clv_profile(b.customers(), b.orders(), b.abandoned_checkouts(), b.refunds())
    out = ML.predict(model, prof, "2001-08-02 00:00:00")
    row = out.first()
    assert row.features_used == M.FEATURES
    scores = {r.clv_confidence_score for r in out.select("clv_confidence_score").distinct().collect()}
    assert scores <= {1.0, 0.8, 0.7, 0.6, 0.56, 0.48, 0.42, 0.34}


def test_scoring_an_untrained_model_is_an_error(spark):
    with pytest.raises(ML.Untrained):
        ML.predict(None, spark.range(0), "2001-08-02 00:00:00")


def test_history_ends_before_as_of(spark):
    """Rows at or after AS_OF are not part of what scoring sees."""
    df = spark.sql("SELECT TIMESTAMP_NTZ '2001-08-01 23:59:59' AS created_at UNION ALL SELECT TIMESTAMP_NTZ '2001-08-02 00:00:00'")
    kept, = ML.history("2001-08-02 00:00:00", df)
    assert kept.count() == 1
