"""Standard feature views of the reference (1-minute and 5-minute card velocity)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from payrisk import schemas as S
from payrisk.operators.pit import FeatureView
from payrisk.operators.velocity import card_velocity_1m, card_velocity_5m


def velocity_views(payments: DataFrame, created: Column | None = None) -> list[FeatureView]:
    """The two offline views: 1m (TTL 120 min) and 5m (TTL 240 min)."""
    f1 = card_velocity_1m(payments, created)
    f5 = card_velocity_5m(payments, created)
    return [
        FeatureView("card_velocity_1m", f1, ("txn_count_1m", "amount_sum_1m"), S.TTL_1M_MINUTES * 60),
        FeatureView("card_velocity_5m", f5, ("txn_count_5m", "avg_transaction_amount_5m"), S.TTL_5M_MINUTES * 60),
    ]
