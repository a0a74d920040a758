"""Batch scoring of payments against point-in-time features (the offline twin of
the scoring stream, STR-6): features as of each event (strict, no look-ahead),
missing-feature flags, defaults, model or fallback, decision."""

from __future__ import annotations

from pyspark.sql import DataFrame

from payrisk import schemas as S
from payrisk.operators.pit import point_in_time_join
from payrisk.operators.score import score, with_missing_flags
from payrisk.plans.features import velocity_views


def score_payments(payments: DataFrame, model=None, version: str | None = None,
                   threshold: float = S.DECISION_THRESHOLD, feature_source: DataFrame | None = None) -> DataFrame:
    """Score every payment with the features that were current at its event time.

    ``feature_source`` is the payment history the feature views are built from
    (defaults to ``payments`` itself).
    Output: event_id, card_id, event_timestamp, amount, the four online
    features (missing → 0), missing_features, fraud_probability, decision,
    model_version.
    """
    views = velocity_views(feature_source if feature_source is not None else payments)
    ent = payments.select("event_id", "card_id", "event_timestamp", "amount")
    joined = point_in_time_join(ent, views)
    flagged = with_missing_flags(joined)
    return score(flagged, model, version, threshold)
