"""Streaming card velocity (STR-1..4): watermark 5 s, 1-minute tumbling
windows per card, append mode — a window is emitted once the watermark
passes its end, and later rows for it are dropped (counted by Spark in
``numRowsDroppedByWatermark``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk import schemas as S


def card_velocity_stream(payments: DataFrame, width: str = "1 minute", lateness: str = S.WATERMARK_DELAY,
                         suffix: str = "1m") -> DataFrame:
    """``payments`` is a streaming frame with ``card_id``, ``amount`` and a UTC
    ``event_time``.  Output: card_id, event_timestamp (window end),
    created_timestamp (processing time), txn_count_<suffix> (count of rows),
    amount_sum_<suffix>.  Rows without a card or time are dropped first, as
    in batch (so stream and batch agree)."""
    src = payments.where(F.col("card_id").isNotNull() & F.col("event_time").isNotNull())
    return (src.withWatermark("event_time", lateness)
               .groupBy("card_id", F.window("event_time", width))
               .agg(F.count(F.lit(1)).alias(f"txn_count_{suffix}"), F.sum("amount").alias(f"amount_sum_{suffix}"))
               .select("card_id", F.col("window.end").alias("event_timestamp"),
                       F.current_timestamp().alias("created_timestamp"),
                       f"txn_count_{suffix}", f"amount_sum_{suffix}"))


def geo_change_stream(payments: DataFrame, width: str = "5 minutes", lateness: str = S.WATERMARK_DELAY) -> DataFrame:
    """EXT-3 on a stream: per card and tumbling window, ``geo_change_flag_5m`` =
    1 when the card was seen in more than one country in the window (the least
    and the greatest one differ: two values of state per window)."""
    src = payments.where(F.col("card_id").isNotNull() & F.col("event_time").isNotNull())
    return (src.withWatermark("event_time", lateness)
               .groupBy("card_id", F.window("event_time", width))
               .agg(F.min("country").alias("_lo"), F.max("country").alias("_hi"))
               .select("card_id", F.col("window.end").alias("event_timestamp"),
                       F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False)).cast("int").alias("geo_change_flag_5m")))


def start_card_velocity(payments: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                        trigger: dict | None = None, width: str = "1 minute", options: dict | None = None):
    """STR-2 + STR-4 wired to a sink: append mode, checkpointed, a micro-batch
    every 10 s by default (the reference's checkpoint interval).  With
    ``fmt="kafka"`` the rows go out as card-keyed JSON records to topic
    ``path``; ``options`` go to the sink (for Kafka: ``kafka.bootstrap.servers``)."""
    out = card_velocity_stream(payments, width)
    w = out.writeStream
    if fmt == "kafka":
        # SNK-2: one JSON record per feature row, keyed by card; `path` is the topic
        from payrisk.streaming.sources import to_json_value

        w = to_json_value(out, key="card_id").writeStream.option("topic", path)
    else:
        w = w.option("path", path)
    return (w.format(fmt).options(**(options or {})).option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(**(trigger or {"processingTime": S.CHECKPOINT_INTERVAL})).start())


def geo_flags_stream(payments: DataFrame, again: DataFrame, seconds: int = 300, lateness: str = S.WATERMARK_DELAY, ts: str = "event_time") -> DataFrame:
    """EXT-3 on a stream, exact: every event with 1 if its card was in another country within the ``seconds`` before, as
    :func:`payrisk.operators.velocity.geo_change_flag` has it in batch.

    ``again`` is the same stream read once more: each event waits for earlier events of its card, other country (an interval join), and
    the matches become one flag per event.  Both states are bounded by the watermark; an event comes out once that is
    ``seconds`` past it.  Repeated deliveries of one event give one row."""
    now = payments.where(F.col("card_id").isNotNull() & F.col(ts).isNotNull()).select("event_id", "card_id", F.col(ts).alias("event_timestamp"), "country").withWatermark("event_timestamp", lateness)
    then = again.where(F.col("card_id").isNotNull() & F.col(ts).isNotNull()).select(F.col("event_id").alias("_id"), F.col("card_id").alias("_card"), F.col(ts).alias("_ts"), F.col("country").alias("_country"))
    then = then.withWatermark("_ts", lateness)
    earlier = (F.col("_ts") < F.col("event_timestamp")) | ((F.col("_ts") == F.col("event_timestamp")) & (F.col("_id") < F.col("event_id")))
    near = (F.col("_ts") <= F.col("event_timestamp")) & (F.col("_ts") >= F.col("event_timestamp") - F.expr(f"INTERVAL {seconds} SECONDS"))
    met = now.join(then, (F.col("card_id") == F.col("_card")) & near & earlier & ~F.col("country").eqNullSafe(F.col("_country")), "leftOuter")
    return met.groupBy("event_id", "card_id", "event_timestamp", "country").agg(F.max(F.col("_card").isNotNull().cast("int")).alias("geo_change_flag_5m"))


def enriched_stream(events: DataFrame, features: DataFrame, views: dict[str, tuple[list[str], int]], lateness: str = S.WATERMARK_DELAY) -> DataFrame:
    """JOIN-5 + EXT-4 as of the event: every event (event_id, card_id, event_timestamp, ..) with the newest feature row of each view that
    was there at its time and not older than the view's TTL.

    ``features``: one stream of the rows of all views: card_id, event_timestamp, created_timestamp, view, and each view's columns;
    ``views``: name -> (columns, TTL in seconds).  An interval join to the feature stream, then one ``max`` of (time, created, values)
    per event and view: two stateful operators, bounded by the watermark.  An event comes out once that is the longest TTL past it."""
    longest = max(ttl for _, ttl in views.values())
    left = events.withWatermark("event_timestamp", lateness)
    right = features.withColumnsRenamed({"card_id": "_card", "event_timestamp": "_ts"}).withWatermark("_ts", lateness)
    known = (F.col("_ts") <= F.col("event_timestamp")) & (F.col("_ts") >= F.col("event_timestamp") - F.expr(f"INTERVAL {longest} SECONDS"))
    met = left.join(right, (F.col("card_id") == F.col("_card")) & known, "leftOuter")
    newest = []
    for view, (cols, ttl) in views.items():
        fresh = (F.col("view") == view) & (F.col("_ts") >= F.col("event_timestamp") - F.expr(f"INTERVAL {ttl} SECONDS"))
        newest.append(F.max(F.when(fresh, F.struct("_ts", "created_timestamp", *cols))).alias(f"_{view}"))
    best = met.groupBy(*events.columns).agg(*newest)
    return best.select(*events.columns, *[F.col(f"_{view}.{c}").alias(c) for view, (cols, _) in views.items() for c in cols])
