"""Model plan: train on history before a cutoff, score every customer (M1-M4).

Boosting is iterative, so this query has no SQL twin; its checks are
the property tests in tests/test_model.py.
"""

from __future__ import annotations

from lifetide.operators import metrics as M
from lifetide.operators import model as ML
from lifetide.plans.catalog import query
from lifetide.sources.bridge import AS_OF, Bridge

# Training window of the bundled plan.
TRAIN_CUTOFF = "2000-08-02 00:00:00"   # features strictly before, target after
HORIZON_DAYS = 365


def _frame(b: Bridge):
    return ML.training_frame(b.customers(), b.orders(), b.abandoned_checkouts(), b.refunds(), TRAIN_CUTOFF, HORIZON_DAYS)


@query("clv_training_frame")
def clv_training_frame(spark, base):
    """Features before the cutoff, the spend after it, and the split (M2)."""
    return ML.split_flag(_frame(Bridge(spark, base)))


@query("clv_predictions")
def clv_predictions(spark, base):
    """Every customer scored on what was known before AS_OF (M3)."""
    b = Bridge(spark, base)
    model = ML.train(_frame(b))
    orders, abandoned, refunds = ML.history(AS_OF, b.orders(), b.abandoned_checkouts(), b.refunds())
    return ML.predict(model, M.clv_profile(b.customers(), orders, abandoned, refunds), AS_OF)
