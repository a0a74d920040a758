"""Event-time tumbling-window features per key (AGG-1, AGG-2, EXT-1..3).

A feature row is stamped with its window *end*; windows are epoch-aligned
``[start, end)``.  One hash aggregate on (key, window): Spark does the
map-side partial aggregate, so only one row per (key, window) per map task
crosses the shuffle, and a hot card is spread over its many windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.functions.columns import window_end


def window_aggregate(df: DataFrame, keys, ts: str, width: str, aggs: dict[str, Column],
                     out_ts: str = "event_timestamp", created: Column | None = None,
                     required=None) -> DataFrame:
    """Group ``df`` by ``keys`` and the tumbling window of ``width`` over ``ts``.

    ``required`` columns are null-filtered first (the batch jobs drop rows
    missing a key, a time or an amount before grouping).  ``created`` adds a
    ``created_timestamp`` column (processing time) when given.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    req = list(required) if required is not None else keys + [ts]
    src = df.dropna(subset=req) if req else df
    out = (src.groupBy(*keys, window_end(ts, width).alias(out_ts))
              .agg(*[c.alias(n) for n, c in aggs.items()]))
    if created is not None:
        out = out.withColumn("created_timestamp", created)
    return out


def card_velocity(payments: DataFrame, width: str = "1 minute", suffix: str = "1m", stats=("count", "sum"),
                  key: str = "card_id", ts: str = "event_timestamp", amount: str = "amount",
                  created: Column | None = None) -> DataFrame:
    """Per-card count/sum/avg of ``amount`` per tumbling window.

    ``stats`` picks the columns: ``count`` → ``txn_count_<suffix>``,
    ``sum`` → ``amount_sum_<suffix>``, ``avg`` → ``avg_transaction_amount_<suffix>``.
    ``count`` counts non-null amounts, after null rows were dropped.
    """
    aggs: dict[str, Column] = {}
    for s in stats:
        if s == "count":
            aggs[f"txn_count_{suffix}"] = F.count(amount)
        elif s == "sum":
            aggs[f"amount_sum_{suffix}"] = F.sum(amount)
        elif s == "avg":
            aggs[f"avg_transaction_amount_{suffix}"] = F.avg(amount)
        else:
            raise ValueError(f"unknown stat {s!r}")
    return window_aggregate(payments, [key], ts, width, aggs, created=created, required=[key, ts, amount])


def card_velocity_1m(payments: DataFrame, created: Column | None = None) -> DataFrame:
    """AGG-1: ``txn_count_1m`` (count of amounts) and ``amount_sum_1m`` per card per minute."""
    return card_velocity(payments, "1 minute", "1m", ("count", "sum"), created=created)


def card_velocity_5m(payments: DataFrame, created: Column | None = None) -> DataFrame:
    """AGG-2: ``txn_count_5m`` and ``avg_transaction_amount_5m`` per card per 5 minutes."""
    return card_velocity(payments, "5 minutes", "5m", ("count", "avg"), created=created)


def merchant_velocity_5m(payments: DataFrame, created: Column | None = None) -> DataFrame:
    """EXT-2: ``merchant_txn_count_5m`` per merchant per 5 minutes."""
    return window_aggregate(payments, ["merchant_id"], "event_timestamp", "5 minutes",
                            {"merchant_txn_count_5m": F.count("amount")}, created=created,
                            required=["merchant_id", "event_timestamp", "amount"])


def card_amount_sum_5m(payments: DataFrame, created: Column | None = None) -> DataFrame:
    """EXT-1: ``card_amount_sum_5m`` per card per 5 minutes."""
    return window_aggregate(payments, ["card_id"], "event_timestamp", "5 minutes",
                            {"card_amount_sum_5m": F.sum("amount")}, created=created,
                            required=["card_id", "event_timestamp", "amount"])


def geo_change_flag(payments: DataFrame, within_seconds: int = 300, bucket_seconds: int = 3600) -> DataFrame:
    """EXT-3 (batch): ``geo_change_flag_5m`` = 1 when the same card was seen in a
    different country within the previous ``within_seconds`` (inclusive), else 0.

    "Earlier" is the order (event_timestamp, event_id) per card.  For a row, the
    newest earlier row with another country is the previous row if its country
    differs; otherwise it is the same as for the previous row.  So it is the
    ``lag`` time at the start of the current run of equal countries, carried
    through the run with ``last(ignorenulls)`` over a running frame.

    A hot card must not land in one task, so the window is partitioned by
    (card, time bucket).  Every row is also replayed, as context that emits
    nothing, into each later bucket that starts within ``within_seconds`` of
    it; older rows cannot matter, so the result equals the unbucketed form.
    """
    from payrisk.functions.columns import epoch_seconds, seconds_between

    base = (payments.select("event_id", "card_id", "event_timestamp", "country")
            .dropna(subset=["card_id", "event_timestamp"]))
    sec = epoch_seconds("event_timestamp")
    bucket = F.floor(sec / F.lit(bucket_seconds))
    # one pass: each row goes to its own bucket and, as context, to every later
    # bucket it can still reach within `within_seconds`
    reach = F.floor((sec + F.lit(within_seconds)) / F.lit(bucket_seconds))
    u0 = (base.withColumn("_own", bucket)
              .withColumn("_bucket", F.explode(F.sequence(bucket, F.greatest(reach, bucket))))
              .withColumn("_ctx", F.col("_bucket") != F.col("_own")).drop("_own"))
    ordered = Window.partitionBy("card_id", "_bucket").orderBy("event_timestamp", "event_id")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = (u0
         .withColumn("_prev_country", F.lag("country").over(ordered))
         .withColumn("_prev_ts", F.lag("event_timestamp").over(ordered))
         .withColumn("_run_start", F.when(F.col("_prev_ts").isNotNull()
                                          & ~F.col("_prev_country").eqNullSafe(F.col("country")),
                                          F.col("_prev_ts")))
         .withColumn("_other_ts", F.last("_run_start", ignorenulls=True).over(running)))
    flag = F.when(F.col("_other_ts").isNotNull()
                  & (seconds_between("event_timestamp", "_other_ts") <= F.lit(float(within_seconds))), 1).otherwise(0)
    return (u.where(~F.col("_ctx"))
             .select("event_id", "card_id", "event_timestamp", "country", flag.alias("geo_change_flag_5m")))
