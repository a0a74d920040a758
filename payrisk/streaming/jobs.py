"""Streaming jobs wired to sinks: validate-and-route (STR-5, SNK-3),
score-and-emit (STR-6, SNK-4, SNK-5, STR-9), late-label join (JOIN-6),
duplicate drop (STR-8).

Every job is checkpointed (``checkpointLocation`` under the shared
checkpoint folder) and every ``foreachBatch`` sink is idempotent per
``batchId`` — a batch re-run after a failure rewrites the same
``batch=<id>`` directory instead of appending twice — so the jobs survive a
lost executor or a driver restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.functions.columns import decision, heuristic_probability, iso_to_timestamp
from payrisk.operators.pit import lookup_latest
from payrisk.operators.score import fill_event_id, with_missing_flags
from payrisk.operators.validate import route, validate_messages
from payrisk.session import drop_path, landed, scratch_path, spread
from payrisk.streaming.online import read_online


def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch={batch_id}"


def dlq_records(dlq: DataFrame) -> DataFrame:
    """SNK-3: dead-letter rows as topic records, without key, with a JSON value of error, raw text, topic, partition and offset."""
    from payrisk.streaming.sources import to_json_value

    return to_json_value(dlq.select(*S.DLQ.fieldNames()))


def route_batch(batch: DataFrame, batch_id: int, valid_root: str, dlq_root: str, dlq_topic: dict | None = None) -> None:
    """STR-5 / SNK-3: write a validated micro-batch's valid rows and dead-letter
    records, each to its own per-batch directory; with ``dlq_topic`` (options of a Kafka writer) the records also go out
    to a topic (again, if a batch is retried)."""
    batch = batch.persist()
    try:
        valid, dlq = route(batch)
        valid.write.mode("overwrite").parquet(_batch_dir(valid_root, batch_id))
        dlq.write.mode("overwrite").parquet(_batch_dir(dlq_root, batch_id))
        if dlq_topic:
            dlq_records(dlq).write.format("kafka").options(**dlq_topic).save()
    finally:
        batch.unpersist()


def start_validation(raw_stream: DataFrame, valid_root: str, dlq_root: str, checkpoint: str,
                     trigger: dict | None = None, dlq_topic: dict | None = None):
    """STR-5: stateless validate-and-route stream with a dead-letter output.

    AGG-17: the ``validation`` observation (rows, ok, dlq per micro-batch) is
    reported in the query progress (``lastProgress['observedMetrics']``).  A micro-batch may be one unsplit
    file, so its messages are spread over the cores before they are parsed."""
    counted = validate_messages(spread(raw_stream)).observe(
        "validation", F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("is_valid").cast("int")).alias("ok"), F.sum((~F.col("is_valid")).cast("int")).alias("dlq"))
    return (counted.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, bid: route_batch(df, bid, valid_root, dlq_root, dlq_topic))
            .trigger(**(trigger or {"processingTime": S.CHECKPOINT_INTERVAL})).start())


def score_batch(batch: DataFrame, batch_id: int, latest_1m_root: str | None, latest_5m_root: str | None,
                decisions_root: str, log_root: str, errors_root: str,
                threshold: float = S.DECISION_THRESHOLD, model=None, version: str | None = None,
                apply_ttl: bool = False, bounded_requests: bool = False, decisions_topic: dict | None = None) -> None:
    """STR-6 for one micro-batch: online features (JOIN-5: the state of the streams
    that keep the latest rows, named by their checkpoints, as of the batch), missing flags, fallback score, decision; writes decisions
    (keyed by card, SNK-4), the prediction log (SNK-5) and rejected requests
    with a reason (STR-9; with the text of the message and the reason it could not be read, where
    ``batch`` comes from ``decode_requests``).  ``model``: a fitted ``PipelineModel`` (ML-4);
    without one the fallback heuristic scores (ML-7).  ``apply_ttl``: a
    latest value older than the view's TTL before the event time counts as
    missing (Q15).  Requests without an event id get a deterministic one
    (PRJ-18, ``event_id_missing``).  Rejected requests also stand in the log,
    with status ``error`` (MON-2).  ``bounded_requests``: the caller has limited the
    rows of a micro-batch (``maxOffsetsPerTrigger``), so its keys may be broadcast.
    ``decisions_topic``: options of a Kafka writer; decisions then also go out
    as records keyed by card.  The log's ``latency_ms`` is decision time
    minus ingest time.

    Requests and scores are used by several outputs, so each is landed once for the length of the batch: a cache of a large batch
    would need memory that grows with its partitions.  A message's text is landed only where it is rejected, and of its
    fields those that are scored or written (all of them for a ``model``)."""
    spark = batch.sparkSession
    if "decode_error" not in batch.columns:
        batch = batch.withColumns({"raw": F.lit(None).cast("string"), "decode_error": F.lit(None).cast("string")})
    work = scratch_path(spark, "score-batch")
    try:
        # FLT-7 / FLT-2: card id non-empty, amount >= 0 (a missing or empty event id is filled)
        ok_req = (F.col("card_id").isNotNull() & (F.col("card_id") != "") & F.col("amount").isNotNull()
                  & (F.col("amount") >= 0))
        reason = (F.when(ok_req, F.lit(None)).when(F.col("decode_error").isNotNull(), F.col("decode_error"))
                   .when(F.col("card_id").isNull() | (F.col("card_id") == ""), F.lit("card_id_empty")).otherwise(F.lit("amount_invalid")))
        request = ["event_id", "card_id", "amount", "event_ts", "ingest_ts"]
        kept = request if model is None else [c for c in batch.columns if c not in ("raw", "decode_error")]
        read = landed(batch.select(*kept, F.when(~ok_req, F.col("raw")).alias("raw"), reason.alias("reason")), f"{work}/requests")
        reqs = fill_event_id(read.where(F.col("reason").isNull()).drop("raw", "reason"), basis=["card_id", "amount", "event_ts", "ingest_ts"], number_equal=True)
        reqs = reqs.withColumn("_as_of", iso_to_timestamp(F.col("event_ts")))
        rejects = landed(read.where(F.col("reason").isNotNull()).select(*request, "raw", "reason"), _batch_dir(errors_root, batch_id))
        feats = reqs
        for root, fields, ttl in ((latest_1m_root, ["txn_count_1m", "amount_sum_1m"], S.TTL_1M_MINUTES * 60),
                                  (latest_5m_root, ["txn_count_5m", "avg_transaction_amount_5m"], S.TTL_5M_MINUTES * 60)):
            lat = read_online(spark, root) if root else None
            if lat is None:
                feats = feats.withColumns({f: F.lit(None).cast("double") for f in fields})
            else:
                feats = lookup_latest(feats, lat, fields, as_of="_as_of" if apply_ttl else None,
                                      ttl_seconds=ttl if apply_ttl else None, bounded_requests=bounded_requests)
        scored = with_missing_flags(feats)
        if model is None:
            scored = (scored.withColumn("fraud_probability", heuristic_probability())
                            .withColumn("decision", decision("fraud_probability", threshold))
                            .withColumn("model_version", F.lit("fallback")))
        else:
            from payrisk.operators.score import score_model

            scored = score_model(scored, model, version or "unknown", threshold)
        scored = scored.withColumn("scored_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        scored = landed(scored.select(*request, *S.ONLINE_FEATURES, "fraud_probability", "decision", "model_version", "scored_at",
                                      "missing_features", "event_id_missing"), f"{work}/scored")
        drop_path(spark, f"{work}/requests")
        decisions = scored.select("event_id", "card_id", "amount", "event_ts", "ingest_ts", "fraud_probability", "decision",
                                  "model_version", "scored_at")
        decisions.write.mode("overwrite").parquet(_batch_dir(decisions_root, batch_id))
        if decisions_topic:
            decision_records(decisions).write.format("kafka").options(**decisions_topic).save()
        latency = F.timestamp_diff("MICROSECOND", iso_to_timestamp(F.col("ingest_ts")),
                                   F.current_timestamp().cast("timestamp_ntz")) / F.lit(1000.0)
        log = scored.select(F.col("scored_at").alias("ts"), "event_id", "card_id", "amount", "event_ts", "ingest_ts",
                      "txn_count_1m", "amount_sum_1m", "txn_count_5m", "avg_transaction_amount_5m",
                      "fraud_probability", "decision", "model_version", F.round(latency, 3).alias("latency_ms"),
                      "missing_features", "event_id_missing", F.lit("ok").alias("status"))
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")
        failed = rejects.select(now, "event_id", "card_id", "amount", "event_ts", "ingest_ts", F.lit("error").alias("status"))
        log.unionByName(failed, allowMissingColumns=True).write.mode("overwrite").json(_batch_dir(log_root, batch_id))
    finally:
        drop_path(spark, work)


def start_scoring(payments: DataFrame, latest_1m_root: str | None, latest_5m_root: str | None, decisions_root: str, log_root: str,
                  errors_root: str, checkpoint: str, trigger: dict | None = None, **options):
    """STR-6 as a stream: decoded ``payments`` scored micro-batch by micro-batch by :func:`score_batch`
    (``options`` go to it), checkpointed; a batch that is run again rewrites its own output."""
    return (payments.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, bid: score_batch(df, bid, latest_1m_root, latest_5m_root, decisions_root, log_root, errors_root, **options))
            .trigger(**(trigger or {"processingTime": S.CHECKPOINT_INTERVAL})).start())


def decision_records(decisions: DataFrame) -> DataFrame:
    """SNK-4: decisions as Kafka records keyed by ``card_id`` with a JSON value."""
    from payrisk.streaming.sources import to_json_value

    return to_json_value(decisions, key="card_id")


def label_join_stream(preds: DataFrame, labels: DataFrame, horizon: str = "150 minutes",
                      pred_delay: str = "10 minutes", label_delay: str = "10 minutes") -> DataFrame:
    """JOIN-6: stream-stream left outer join of predictions (``event_id``,
    ``ts``) to labels (``l_event_id``, ``label_timestamp``) with watermarks on
    both sides and ``label_timestamp BETWEEN ts AND ts + horizon``; a
    prediction without a label inside the horizon is emitted with nulls once
    the watermark passes."""
    p = preds.withWatermark("ts", pred_delay)
    lab = labels.withWatermark("label_timestamp", label_delay)
    cond = ((F.col("event_id") == F.col("l_event_id"))
            & (F.col("label_timestamp") >= F.col("ts"))
            & (F.col("label_timestamp") <= F.col("ts") + F.expr(f"INTERVAL {horizon}")))
    return p.join(lab, cond, "leftOuter")


def drop_duplicate_deliveries(stream: DataFrame, key: str = "event_id", ts: str = "event_time",
                              delay: str = "10 minutes") -> DataFrame:
    """STR-8: drop repeated deliveries of one event id within the watermark; events without an id all pass."""
    marked = stream.withWatermark(ts, delay)
    missing = F.col(key).isNull() | (F.col(key) == "")
    return marked.where(~missing).dropDuplicatesWithinWatermark([key]).unionByName(marked.where(missing))
