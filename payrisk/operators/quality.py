"""Data-quality rules and the ingest report (AGG-3, AGG-4).

All row-level rules are conditional sums in one ``agg``; the p99.9 rule uses
the bounded-memory exact quantile; schema rules read ``df.schema`` (metadata
only).  Rules on a missing column are skipped; the
missing-column error itself is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk import schemas as S

REQUIRED_COLUMNS = ["card_id", "merchant_id", "event_timestamp", "amount", "is_fraud"]


def quality_errors(df: DataFrame, p999_limit: float = S.AMOUNT_P999_LIMIT) -> DataFrame:
    """One row ``validation_errors`` (array<string>, empty when clean), in rule order:
    missing columns, amount nulls / negatives / p99.9, labels outside {0,1}
    (with count), timestamp nulls / dtype / zone."""
    cols = set(df.columns)
    missing = [c for c in REQUIRED_COLUMNS if c not in cols]
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    if "amount" in cols:
        a = F.col("amount")
        from payrisk.operators.quantiles import exact_quantiles

        p999 = exact_quantiles(df, "amount", [0.999])[0]
        aggs += [F.sum(F.when(a.isNull(), 1).otherwise(0)).alias("_a_null"),
                 F.sum(F.when(a < 0, 1).otherwise(0)).alias("_a_neg")]
    if "is_fraud" in cols:
        y = F.col("is_fraud")
        aggs.append(F.sum(F.when(~y.isin(*S.FRAUD_LABELS) | y.isNull(), 1).otherwise(0)).alias("_bad_y"))
    ts_type = df.schema["event_timestamp"].dataType if "event_timestamp" in cols else None
    if ts_type is not None:
        aggs.append(F.sum(F.when(F.col("event_timestamp").isNull(), 1).otherwise(0)).alias("_ts_null"))
    r = df.agg(*aggs)
    errs: list[Column] = []
    if missing:
        errs.append(F.lit(f"missing_required_columns={missing}"))
    if "amount" in cols:
        errs += [F.when(F.col("_a_null") > 0, F.lit("amount_has_nulls")),
                 F.when(F.col("_a_neg") > 0, F.lit("amount_has_negative_values"))]
        if p999 is not None and p999 > p999_limit:
            # the quantile is a driver-side scalar: format it as Python prints a float
            errs.append(F.lit(f"amount_p999_too_high p999={float(p999)}"))
    if "is_fraud" in cols:
        errs.append(F.when(F.col("_bad_y") > 0, F.concat(F.lit("is_fraud_has_invalid_values count="),
                                                          F.col("_bad_y").cast("string"))))
    if ts_type is not None:
        errs.append(F.when(F.col("_ts_null") > 0, F.lit("event_timestamp_has_nulls")))
        if not isinstance(ts_type, (T.TimestampType, T.TimestampNTZType)):
            errs.append(F.lit("event_timestamp_not_datetime_dtype"))
        if not isinstance(ts_type, T.TimestampType):
            errs.append(F.lit("event_timestamp_not_utc"))
    return r.select(F.array_compact(F.array(*errs)) if errs else F.array().cast("array<string>")) \
            .toDF("validation_errors")


def ingest_report(payments: DataFrame, start_time_utc: str, n_cards: int, n_merchants: int) -> DataFrame:
    """AGG-3 + AGG-4: one row rows, fraud_rate, amount_min, amount_max,
    start_time_utc, n_cards, n_merchants, validation_errors."""
    r = payments.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col("is_fraud").cast("double")).alias("_fr"),
                     F.min(F.col("amount").cast("double")).alias("amount_min"),
                     F.max(F.col("amount").cast("double")).alias("amount_max"))
    errs = quality_errors(payments).scalar()
    return r.select(
        "rows", F.coalesce(F.col("_fr"), F.lit(0.0)).alias("fraud_rate"), "amount_min", "amount_max",
        F.lit(start_time_utc).alias("start_time_utc"), F.lit(int(n_cards)).alias("n_cards"),
        F.lit(int(n_merchants)).alias("n_merchants"), errs.alias("validation_errors"))
