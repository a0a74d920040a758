"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through the stand-in mappings of
``payrisk.sources.fixtures``) and runs the library's operators over the whole
input.  Doubles are rounded to 6 digits and every column is aliased so the
DuckDB oracle (``oracles.duckdb_sql``) can be compared by name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.functions.columns import round6, window_end
from payrisk.operators import boosting, metrics, monitor, pit, quality, stored, topk, validate, velocity
from payrisk.operators import psi as psi_op
from payrisk.operators.quantiles import exact_quantiles
from payrisk.operators.score import fill_event_id
from payrisk.operators.split import stratified_split
from payrisk.plans import evaluate as ev
from payrisk.plans import ingest as ing
from payrisk.plans import train as tr
from payrisk.plans.features import velocity_views
from payrisk.session import configure, scratch_path, spread
from payrisk.sources import fixtures, logs
from payrisk.streaming import incremental, online
from payrisk.streaming import jobs as sjobs
from payrisk.streaming import sources as ssrc
from payrisk.streaming.features import card_velocity_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _pay(spark: SparkSession, sf_dir: str, large: bool = False) -> DataFrame:
    configure(spark)
    return fixtures.payments_large(spark, sf_dir) if large else fixtures.payments(spark, sf_dir)


def _round(df: DataFrame, cols) -> DataFrame:
    return df.select(*[round6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- features
@register("card_velocity_1m")
def q_card_velocity_1m(spark, sf_dir):
    """AGG-1: per-card 1-minute count and sum of amounts."""
    return _round(velocity.card_velocity_1m(_pay(spark, sf_dir)), ["amount_sum_1m"])


@register("card_velocity_5m")
def q_card_velocity_5m(spark, sf_dir):
    """AGG-2: per-card 5-minute count and mean of amounts."""
    return _round(velocity.card_velocity_5m(_pay(spark, sf_dir)), ["avg_transaction_amount_5m"])


@register("card_velocity_1h")
def q_card_velocity_1h(spark, sf_dir):
    """AGG-1/2 at 1 hour: count, sum and mean per card."""
    df = velocity.card_velocity(_pay(spark, sf_dir), "1 hour", "1h", ("count", "sum", "avg"))
    return _round(df, ["amount_sum_1h", "avg_transaction_amount_1h"])


@register("card_velocity_1d")
def q_card_velocity_1d(spark, sf_dir):
    """AGG-1/2 at 1 day: count, sum and mean per card."""
    df = velocity.card_velocity(_pay(spark, sf_dir), "1 day", "1d", ("count", "sum", "avg"))
    return _round(df, ["amount_sum_1d", "avg_transaction_amount_1d"])


@register("card_velocity_1m_large")
def q_card_velocity_1m_large(spark, sf_dir):
    """AGG-1 over the lineitem ⨝ orders payments (customer = card)."""
    return _round(velocity.card_velocity_1m(_pay(spark, sf_dir, large=True)), ["amount_sum_1m"])


@register("merchant_count_5m")
def q_merchant_count_5m(spark, sf_dir):
    """EXT-2: merchant_txn_count_5m per merchant per 5 minutes."""
    return velocity.merchant_velocity_5m(_pay(spark, sf_dir))


@register("card_amount_sum_5m")
def q_card_amount_sum_5m(spark, sf_dir):
    """EXT-1: card_amount_sum_5m per card per 5 minutes."""
    return _round(velocity.card_amount_sum_5m(_pay(spark, sf_dir)), ["card_amount_sum_5m"])


@register("geo_change")
def q_geo_change(spark, sf_dir):
    """EXT-3: card seen in another country within the previous 5 minutes."""
    return velocity.geo_change_flag(_pay(spark, sf_dir))


# ---------------------------------------------------------------- point in time
def _entities(pay: DataFrame, aligned: bool) -> DataFrame:
    ent = pay.dropna(subset=["card_id", "event_timestamp", "amount", "is_fraud"])
    ts = window_end("event_timestamp", "5 minutes") if aligned else F.col("event_timestamp")
    return ent.select("event_id", "card_id", ts.alias("event_timestamp"), "amount", "is_fraud")


@register("pit_1m_strict")
def q_pit_1m_strict(spark, sf_dir):
    """JOIN-1: as-of join of 1-minute features at the raw event time, TTL 120 min."""
    pay = _pay(spark, sf_dir)
    views = velocity_views(pay)[:1]
    out = pit.point_in_time_join(_entities(pay, aligned=False), views)
    return _round(out, ["amount_sum_1m"])


def _pit_aligned(spark, sf_dir, large=False, bucket_seconds=pit.DEFAULT_BUCKET_SECONDS):
    pay = _pay(spark, sf_dir, large)
    views = velocity_views(pay)
    fill = {"txn_count_1m": 0, "amount_sum_1m": 0.0, "txn_count_5m": 0, "avg_transaction_amount_5m": 0.0}
    out = pit.point_in_time_join(_entities(pay, aligned=True), views, fill=fill, bucket_seconds=bucket_seconds)
    return _round(out, ["amount_sum_1m", "avg_transaction_amount_5m"])


@register("pit_1m_5m_aligned")
def q_pit_1m_5m_aligned(spark, sf_dir):
    """JOIN-2 + PRJ-13 + PRJ-7: two views (TTL 120/240 min) at the 5-minute window end, missing → 0."""
    return _pit_aligned(spark, sf_dir)


@register("pit_1m_5m_aligned_large")
def q_pit_1m_5m_aligned_large(spark, sf_dir):
    """JOIN-2 over the lineitem ⨝ orders payments."""
    return _pit_aligned(spark, sf_dir, large=True)


@register("pit_1m_5m_stored")
def q_pit_1m_5m_stored(spark, sf_dir):
    """JOIN-2 over stored features: both views bucketed by (card, hour) first, so only the entity rows are shuffled by the join."""
    pay = _pay(spark, sf_dir)
    root = scratch_path(spark, "stored-views")
    views = velocity_views(pay)
    buckets = stored.buckets_for(pay.count(), views)  # a feature row comes from one payment at least
    views = [stored.store_view(v, f"{root}/{v.name}", buckets) for v in views]
    fill = {"txn_count_1m": 0, "amount_sum_1m": 0.0, "txn_count_5m": 0, "avg_transaction_amount_5m": 0.0}
    out = stored.join_stored(_entities(pay, aligned=True), views, fill=fill)
    return _round(out, ["amount_sum_1m", "avg_transaction_amount_5m"])


def _delivered(spark, sf_dir, view):
    """All payments in three deliveries (the second half of the month before the first, then every tenth payment late), the views
    updated after each."""
    pay = _pay(spark, sf_dir)
    root = scratch_path(spark, "deliveries")
    late = F.pmod(F.col("event_id").cast("long"), F.lit(10)) == 0
    first = F.col("event_timestamp") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (~late & ~F.coalesce(first, F.lit(False)), ~late & F.coalesce(first, F.lit(False)), late):
        pay.where(part).write.mode("append").parquet(f"{root}/payments")
        incremental.start_views(spark, f"{root}/payments", pay.schema, f"{root}/views", f"{root}/ckpt", views=(view,)).awaitTermination()
    return incremental.read_view(spark, f"{root}/views", view)


@register("card_velocity_1m_deliveries")
def q_card_velocity_1m_deliveries(spark, sf_dir):
    """AGG-1 by deliveries of files: just the windows that a delivery touches are computed again, late rows included."""
    return _round(_delivered(spark, sf_dir, "1m").select("card_id", "event_timestamp", "txn_count_1m", "amount_sum_1m"), ["amount_sum_1m"])


@register("card_velocity_5m_deliveries")
def q_card_velocity_5m_deliveries(spark, sf_dir):
    """AGG-2 by deliveries of files, as the 1-minute view."""
    out = _delivered(spark, sf_dir, "5m").select("card_id", "event_timestamp", "txn_count_5m", "avg_transaction_amount_5m")
    return _round(out, ["avg_transaction_amount_5m"])


@register("latest_features")
def q_latest_features(spark, sf_dir):
    """WIN-3: newest 1-minute feature row per card."""
    f1 = velocity.card_velocity_1m(_pay(spark, sf_dir))
    return _round(pit.latest_per_key(f1), ["amount_sum_1m"])


@register("online_lookup")
def q_online_lookup(spark, sf_dir):
    """SNK-9: every payment's card looked up in the latest-per-card tables of both views."""
    pay = _pay(spark, sf_dir)
    v1, v5 = velocity_views(pay)
    req = pay.select("event_id", "card_id")
    out = pit.lookup_latest(req, pit.latest_per_key(v1.df), list(v1.fields))
    out = pit.lookup_latest(out, pit.latest_per_key(v5.df), list(v5.fields))
    return _round(out, ["amount_sum_1m", "avg_transaction_amount_5m"])


# ---------------------------------------------------------------- scoring

_D6 = ["amount", "amount_sum_1m", "avg_transaction_amount_5m", "fraud_probability"]


_LANDED: dict[tuple, str] = {}


def _landed(spark, sf_dir, name: str, build) -> DataFrame:
    """Stand-in logs are landed once per session as Parquet under the shared
    checkpoint folder (the reference reads them from files) and read back."""
    key = (name, sf_dir, spark.sparkContext.applicationId)
    if key not in _LANDED:
        path = scratch_path(spark, f"landed-{name}")
        build().write.mode("overwrite").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def _log(spark, sf_dir):
    return _landed(spark, sf_dir, "prediction-log", lambda: fixtures.prediction_log(_pay(spark, sf_dir)))


def _labels(spark, sf_dir):
    return _landed(spark, sf_dir, "labels-log", lambda: fixtures.labels_log(_pay(spark, sf_dir)))


@register("heuristic_scores")
def q_heuristic_scores(spark, sf_dir):
    """ML-3 + ML-8 + PRJ-6 + PRJ-15: strict point-in-time features, missing flags, fallback score, decision."""
    from payrisk.plans.score import score_payments

    s = score_payments(_pay(spark, sf_dir))
    s = s.withColumn("missing_features", F.array_join("missing_features", ","))
    return _round(s, _D6)


@register("decision_counts")
def q_decision_counts(spark, sf_dir):
    """PRJ-15: decisions and their counts (error records have none)."""
    return _log(spark, sf_dir).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@register("missing_feature_counts")
def q_missing_feature_counts(spark, sf_dir):
    """ML-8: how often each online feature was missing at scoring time."""
    return (_log(spark, sf_dir).select(F.explode("missing_features").alias("feature"))
            .groupBy("feature").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- evaluation pieces
@register("labels_latest")
def q_labels_latest(spark, sf_dir):
    """WIN-1: newest label per event id (re-labels win)."""
    return ev.latest_labels(_labels(spark, sf_dir))


@register("predictions_latest")
def q_predictions_latest(spark, sf_dir):
    """WIN-2: newest prediction per event id."""
    return _round(ev.latest_predictions(_log(spark, sf_dir)), ["fraud_probability"])


def _eligible(spark, sf_dir):
    labels_d = ev.latest_labels(_labels(spark, sf_dir))
    preds_d = ev.latest_predictions(_log(spark, sf_dir))
    return ev.eligible_predictions(preds_d, labels_d), labels_d


@register("prediction_label_join")
def q_prediction_label_join(spark, sf_dir):
    """FLT-4 + JOIN-3: eligible predictions left-joined to their newest label."""
    el, labels_d = _eligible(spark, sf_dir)
    return _round(ev.join_labels(el, labels_d), ["fraud_probability"])


@register("unlabeled_predictions")
def q_unlabeled_predictions(spark, sf_dir):
    """JOIN-4: eligible predictions without any label."""
    el, labels_d = _eligible(spark, sf_dir)
    return _round(ev.unlabeled(el, labels_d), ["fraud_probability"])


def _matched(spark, sf_dir):
    el, labels_d = _eligible(spark, sf_dir)
    return ev.join_labels(el, labels_d).where(F.col("is_fraud").isNotNull())


@register("confusion")
def q_confusion(spark, sf_dir):
    """AGG-6: 2×2 confusion matrix at threshold 0.5 (non_fraud, fraud)."""
    return metrics.classification_summary(_matched(spark, sf_dir)).select("tn", "fp", "fn", "tp")


@register("precision_recall")
def q_precision_recall(spark, sf_dir):
    """AGG-7 + AGG-9: precision and recall (0 on zero division), class count."""
    s = metrics.classification_summary(_matched(spark, sf_dir))
    return _round(s.select("n", "precision", "recall", "n_classes"), ["precision", "recall"])


@register("average_precision")
def q_average_precision(spark, sf_dir):
    """AGG-8 + WIN-4: average precision over distinct scores (two-level running sums)."""
    return _round(metrics.average_precision(_matched(spark, sf_dir)), ["pr_auc"])


@register("label_lag_quantiles")
def q_label_lag_quantiles(spark, sf_dir):
    """AGG-5: exact p50/p95 of label lag (seconds), linear interpolation."""
    from payrisk.functions.columns import seconds_between

    m = _matched(spark, sf_dir).select(seconds_between("label_timestamp", "ts").alias("lag"))
    p50, p95 = exact_quantiles(m, "lag", [0.5, 0.95])
    return spark.range(1).select(round6(F.lit(p50).cast("double")).alias("label_lag_p50_s"),
                                 round6(F.lit(p95).cast("double")).alias("label_lag_p95_s"))


_SUMMARY_D = ["join_rate", "precision", "recall", "pr_auc", "label_lag_p50_s", "label_lag_p95_s"]


@register("eval_event_id")
def q_eval_event_id(spark, sf_dir):
    """ML-10 / AGG-14: event-id evaluation summary (partial joins allowed)."""
    s = ev.evaluate_event_id(_log(spark, sf_dir), _labels(spark, sf_dir), allow_partial=True)
    return _round(s, _SUMMARY_D)


@register("eval_event_id_docs")
def q_eval_event_id_docs(spark, sf_dir):
    """ML-10 on document scores vs quality labels (truly partial label coverage)."""
    configure(spark)
    preds, labels = fixtures.document_predictions(spark, sf_dir)
    return _round(ev.evaluate_event_id(preds, labels, allow_partial=True), _SUMMARY_D)


@register("quality_gate")
def q_quality_gate(spark, sf_dir):
    """AGG-15: staging gate (join ≥ 0.99, precision ≥ 0.003, recall ≥ 0.20, PR-AUC ≥ 0.004)."""
    s = ev.evaluate_event_id(_log(spark, sf_dir), _labels(spark, sf_dir), allow_partial=True)
    g = ev.quality_gate(s, **S.GATE_STAGING)
    return _round(g.select("join_rate", "precision", "recall", "pr_auc", "gate_failures", "gate_passed"),
                  ["join_rate", "precision", "recall", "pr_auc"])


@register("eval_delayed")
def q_eval_delayed(spark, sf_dir):
    """ML-9: delayed-label offline evaluation with the fallback model, plus drift."""
    s = ev.evaluate_delayed(_pay(spark, sf_dir))
    return _round(s, ["precision", "recall", "pr_auc", "psi_amount", "psi_txn_count_1m"])


@register("recent_top_n")
def q_recent_top_n(spark, sf_dir):
    """TOPK-2: the 5,000 newest prediction-log records (ts, then event_id, descending)."""
    log = _log(spark, sf_dir).select("ts", "event_id", "card_id", "amount", "fraud_probability")
    return _round(topk.tail_by_time(log, S.RECENT_ROWS, "ts", ("event_id",)), ["amount", "fraud_probability"])


@register("newest_n")
def q_newest_n(spark, sf_dir):
    """TOPK-1: the newest 500 predictions of the whole log, one per event (ts, then event_id, descending)."""
    return _round(topk.tail_by_time(ev.latest_predictions(_log(spark, sf_dir)), 500, "ts", ("event_id",)), ["fraud_probability"])


@register("label_delay_cutoff")
def q_label_delay_cutoff(spark, sf_dir):
    """FLT-3 + AGG-16: payments at least 60 minutes older than the newest payment."""
    p = _pay(spark, sf_dir)
    cut = topk.max_minus(p, "event_timestamp", S.LABEL_DELAY_MINUTES)
    return topk.before_cutoff(p, "event_timestamp", cut).select("event_id", "card_id", "event_timestamp", "amount")


# ---------------------------------------------------------------- drift
def _recent(spark, sf_dir):
    return topk.tail_by_time(_log(spark, sf_dir), S.RECENT_ROWS, "ts", ("event_id",))


@register("psi_bins_amount")
def q_psi_bins_amount(spark, sf_dir):
    """AGG-11: decile bins of payment amounts (expected) vs the recent log (actual)."""
    t = psi_op.psi_bins(_pay(spark, sf_dir), _recent(spark, sf_dir), "amount")
    return _round(t.select("bin", "n_expected_bin", "n_actual_bin", "e_share", "a_share"), ["e_share", "a_share"])


@register("psi_report")
def q_psi_report(spark, sf_dir):
    """AGG-12 + AGG-13: drift report over amount, txn_count_1m and amount_sum_1m, plus n_recent."""
    from payrisk.plans.drift import drift_report

    pay = _pay(spark, sf_dir)
    return _round(drift_report(pay, velocity.card_velocity_1m(pay), _recent(spark, sf_dir)), ["psi"])


@register("psi_bins_amount_all")
def q_psi_bins_amount_all(spark, sf_dir):
    """AGG-11: decile bins of payment amounts (expected) vs the whole log (actual)."""
    t = psi_op.psi_bins(_pay(spark, sf_dir), _log(spark, sf_dir), "amount")
    return _round(t.select("bin", "n_expected_bin", "n_actual_bin", "e_share", "a_share"), ["e_share", "a_share"])


@register("psi_report_all")
def q_psi_report_all(spark, sf_dir):
    """AGG-12 + AGG-13: the drift report against the whole log."""
    from payrisk.plans.drift import drift_report

    pay = _pay(spark, sf_dir)
    return _round(drift_report(pay, velocity.card_velocity_1m(pay), _log(spark, sf_dir)), ["psi"])


@register("psi_amount_halves")
def q_psi_amount_halves(spark, sf_dir):
    """AGG-12: PSI of payment amounts, first half of the month (expected) vs the rest."""
    pay = _pay(spark, sf_dir)
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    r = psi_op.psi(pay.where(F.col("event_timestamp") < mid), pay.where(F.col("event_timestamp") >= mid), "amount")
    return _round(r, ["psi"])


# ---------------------------------------------------------------- validation / ingest


def _raw(spark, sf_dir):
    configure(spark)
    return fixtures.landed_messages(spark, sf_dir, scratch_path(spark, "raw-messages"))


def _masked(col: str):
    """A message's text with the digits of its doubles left out, which SQL engines print differently."""
    return F.regexp_replace(col, r'("(amount|lat|lon)":"?)-?[0-9.E]+', "$1#").alias(col)


@register("dlq_reasons")
def q_dlq_reasons(spark, sf_dir):
    """FLT-5 + AGG-17: strict JSON validation of every raw message; count per outcome (ok or first error)."""
    return validate.validation_counts(_raw(spark, sf_dir))


@register("dlq_records")
def q_dlq_records(spark, sf_dir):
    """SNK-3: dead-letter records (error, raw, topic, partition, offset) of the invalid messages, as topic records
    whose JSON value is read back.  The partition is compared by its range, as its hash has no SQL form."""
    _, dlq = validate.split_valid(_raw(spark, sf_dir))
    records = sjobs.dlq_records(dlq).select(F.from_json("value", S.DLQ).alias("v")).select("v.*")
    return records.select("offset", "error", "topic", _masked("raw"), F.col("partition").between(0, fixtures.TOPIC_PARTITIONS - 1).alias("in_topic"))


@register("valid_payments")
def q_valid_payments(spark, sf_dir):
    """PRJ-1 + PRJ-2: valid messages decoded to typed columns, event time truncated to the second."""
    valid, _ = validate.split_valid(_raw(spark, sf_dir))
    et = F.date_trunc("second", F.try_to_timestamp("event_ts")).cast("timestamp_ntz")
    return _round(valid.select("event_id", "card_id", "amount", "channel", "is_card_present", "is_fraud",
                               et.alias("event_time")), ["amount"])


def _csv(spark, sf_dir):
    configure(spark)
    return fixtures.creditcard_csv(spark, sf_dir, scratch_path(spark, "creditcard-csv"))


@register("ingest_payments")
def q_ingest_payments(spark, sf_dir):
    """SRC-5 + PRJ-3..12 + FLT-1/2: CSV → payments with contiguous index, pseudo ids, UUIDv5, geo."""
    pay, _ = ing.ingest_csv(spark, _csv(spark, sf_dir))
    return pay.select("idx", "event_id", "card_id", "merchant_id",
                      F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                      "amount", "channel", "country", "city", "lat", "lon", "is_fraud")


@register("ingest_report")
def q_ingest_report(spark, sf_dir):
    """AGG-3 + AGG-4: ingest report over the ingested payments."""
    _, rep = ing.ingest_csv(spark, _csv(spark, sf_dir))
    return _round(rep.withColumn("validation_errors", F.array_join("validation_errors", "; ")), ["fraud_rate"])


@register("quality_rules")
def q_quality_rules(spark, sf_dir):
    """AGG-4: quality rules on the raw typed CSV rows (before cleaning)."""
    raw = ing.read_creditcard_csv(spark, _csv(spark, sf_dir))
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    typed = raw.select(
        F.timestamp_add("MICROSECOND", F.round(F.col("Time").try_cast("double") * 1e6).cast("long"), base)
         .alias("event_timestamp"),
        F.col("Amount").try_cast("double").alias("amount"),
        F.col("Class").try_cast("int").alias("is_fraud"))
    return quality.quality_errors(typed).select(F.array_join("validation_errors", "; ").alias("validation_errors"))


# ---------------------------------------------------------------- monitoring


@register("decisions_per_minute")
def q_decisions_per_minute(spark, sf_dir):
    """MON-1: predictions per decision per minute and per-second rate."""
    return _round(monitor.decisions_per_window(_log(spark, sf_dir)), ["rate_per_s"])


@register("error_ratio_2m")
def q_error_ratio_2m(spark, sf_dir):
    """MON-2 + MON-7: request error ratio over sliding 2-minute windows (slide 1 minute), alert > 5 %,
    firing once held for 2 minutes."""
    return _round(monitor.with_firing(monitor.error_ratio(_log(spark, sf_dir))), ["error_ratio"])


@register("latency_histogram")
def q_latency_histogram(spark, sf_dir):
    """MON-3: cumulative scoring-latency histogram per hour."""
    return monitor.latency_histogram(_log(spark, sf_dir))


@register("latency_quantiles")
def q_latency_quantiles(spark, sf_dir):
    """MON-4 + MON-7: p50/p95 latency by histogram interpolation per sliding 2-minute window,
    alert p95 > 0.25 s, firing once held for 2 minutes."""
    return _round(monitor.with_firing(monitor.latency_quantiles(_log(spark, sf_dir))), ["p50_s", "p95_s"])


@register("missing_rate")
def q_missing_rate(spark, sf_dir):
    """MON-5: missing-feature counts and rates by feature per minute."""
    return _round(monitor.missing_feature_rates(_log(spark, sf_dir)), ["rate_per_s"])


@register("missing_alert")
def q_missing_alert(spark, sf_dir):
    """MON-5 + MON-7: total missing-feature rate over sliding 2-minute windows, alert > 1/s,
    firing once held for 2 minutes."""
    return _round(monitor.with_firing(monitor.missing_feature_alert(_log(spark, sf_dir))), ["rate_per_s"])


@register("idle_gaps")
def q_idle_gaps(spark, sf_dir):
    """MON-6 + MON-7: per minute of the log, predictions, the 5-minute idle condition and its 10-minute hold, over a log with an
    outage of five days."""
    return monitor.idle_alert(fixtures.with_outage(_log(spark, sf_dir)))


@register("idle_times")
def q_idle_times(spark, sf_dir):
    """MON-6 + MON-7: one row per time without predictions in the last 5 minutes (first and last minute, and from when the alert
    fires after 10 more), over the same log."""
    return monitor.idle_gaps(fixtures.with_outage(_log(spark, sf_dir)))


@register("alert_hold")
def q_alert_hold(spark, sf_dir):
    """MON-7: firing episodes of the idle alert, over a log with an outage of five days."""
    return monitor.idle_episodes(fixtures.with_outage(_log(spark, sf_dir)))


@register("requests_per_minute")
def q_requests_per_minute(spark, sf_dir):
    """MON-2: requests by status per minute and per-second rate."""
    return _round(monitor.request_rates(_log(spark, sf_dir)), ["rate_per_s"])


@register("missing_event_ids")
def q_missing_event_ids(spark, sf_dir):
    """MON-8 + PRJ-18: requests without an event id (id mod 199 = 0 in the stand-in) get a
    deterministic generated id; count them per minute."""
    pay = _pay(spark, sf_dir)
    eid = F.col("event_id").cast("long")
    req = pay.select(F.when(F.pmod(eid, F.lit(199)) != 0, F.col("event_id")).alias("event_id"), "card_id", "amount",
                     F.col("event_timestamp").alias("ts"))
    filled = fill_event_id(req)
    return monitor.missing_event_ids(filled)


# ---------------------------------------------------------------- streams


def _run_available_now(df, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append"):
    q = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


@register("stream_card_velocity_1m")
def q_stream_card_velocity_1m(spark, sf_dir):
    """STR-1..3 + SRC-1 + PRJ-1/2: JSON payment stream → 5 s watermark → 1-minute tumbling
    count/sum per card, append mode, checkpointed sink (STR-4; run to completion with
    availableNow here, the 10 s trigger is ``start_card_velocity``); windows closed by the
    final watermark."""
    root = scratch_path(spark, "stream-velocity")
    fixtures.land_json_lines(fixtures.payment_json_lines(_pay(spark, sf_dir)), f"{root}/in")
    stream = ssrc.decode_payments(ssrc.json_lines_source(spark, f"{root}/in"))
    _run_available_now(card_velocity_stream(stream), f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out")
    return _round(out.select("card_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                             "txn_count_1m", "amount_sum_1m"), ["amount_sum_1m"])


@register("stream_validation")
def q_stream_validation(spark, sf_dir):
    """STR-5 + SRC-2 + SNK-3: validate-and-route stream (foreachBatch, per-batch idempotent
    outputs); outcome counts over the valid and dead-letter outputs."""
    raw_path = scratch_path(spark, "raw-messages")
    fixtures.landed_messages(spark, sf_dir, raw_path)
    root = scratch_path(spark, "stream-validation")
    src = ssrc.file_message_source(spark, raw_path, max_files_per_trigger=1)
    q = sjobs.start_validation(src, f"{root}/valid", f"{root}/dlq", f"{root}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    valid = spark.read.parquet(f"{root}/valid/*").select(F.lit("ok").alias("outcome"))
    dlq = spark.read.parquet(f"{root}/dlq/*").select(F.col("error").alias("outcome"))
    return valid.unionByName(dlq).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _feature_files(spark, sf_dir, root, view: str):
    pay = _pay(spark, sf_dir)
    f = velocity.card_velocity_1m(pay) if view == "1m" else velocity.card_velocity_5m(pay)
    f = f.withColumn("created_timestamp", F.col("event_timestamp"))
    f.write.mode("overwrite").parquet(f"{root}/features_{view}")
    return spark.read.parquet(f"{root}/features_{view}").schema


def _online(spark, sf_dir, root, view: str, files: int | None = None) -> str:
    """Checkpoint of a finished run of the stream that keeps the newest feature row per card."""
    schema = _feature_files(spark, sf_dir, root, view)
    source = spark.readStream.schema(schema)
    source = source.option("maxFilesPerTrigger", str(files)) if files else source
    checkpoint = f"{root}/online_{view}"
    online.start_online(source.parquet(f"{root}/features_{view}"), checkpoint, {"availableNow": True}).awaitTermination()
    return checkpoint


@register("stream_latest_features")
def q_stream_latest_features(spark, sf_dir):
    """STR-7 + SNK-6 + WIN-3: feature stream, one file a micro-batch, aggregated to the newest row per card in
    update mode; the table is the stream's state, read back through the state data source."""
    configure(spark)
    latest = online.read_online(spark, _online(spark, sf_dir, scratch_path(spark, "stream-online"), "1m", 1))
    return _round(latest.select("card_id", "event_timestamp", "txn_count_1m", "amount_sum_1m"), ["amount_sum_1m"])


def _scored(spark, sf_dir) -> str:
    """Root of a scoring stream run over all payments: decisions, log and errors of its micro-batches."""
    configure(spark)
    root = scratch_path(spark, "stream-score")
    latest = [_online(spark, sf_dir, root, view) for view in ("1m", "5m")]
    fixtures.land_json_lines(fixtures.payment_json_lines(spread(_pay(spark, sf_dir))), f"{root}/in")
    stream = ssrc.decode_payments(ssrc.json_lines_source(spark, f"{root}/in"))
    sjobs.start_scoring(stream, *latest, f"{root}/decisions", f"{root}/log", f"{root}/errors", f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return root


@register("stream_scores")
def q_stream_scores(spark, sf_dir):
    """STR-6 + JOIN-5 + SNK-4/5 + STR-9: payment stream scored per micro-batch against the
    latest-per-card tables of both views (heuristic model); the emitted decisions."""
    dec = spark.read.parquet(f"{_scored(spark, sf_dir)}/decisions/*")
    return _round(dec.select("event_id", "card_id", "amount", "fraud_probability", "decision", "model_version"),
                  ["amount", "fraud_probability"])


@register("stream_errors")
def q_stream_errors(spark, sf_dir):
    """STR-9: raw messages through the scoring stream; each message that is not scored with its text and the reason."""
    configure(spark)
    root = scratch_path(spark, "stream-errors")
    fixtures.landed_messages(spark, sf_dir, f"{root}/in")
    stream = ssrc.decode_requests(ssrc.file_message_source(spark, f"{root}/in"))
    sjobs.start_scoring(stream, None, None, f"{root}/decisions", f"{root}/log", f"{root}/errors", f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{root}/errors/*").select("event_id", "card_id", "reason", _masked("raw"))


@register("decision_records")
def q_decision_records(spark, sf_dir):
    """SNK-4 + STR-6: the scoring stream's decisions as topic records, keyed by card with a JSON value; the
    value's fields read back (without the scoring time)."""
    dec = spark.read.parquet(f"{_scored(spark, sf_dir)}/decisions/*")
    value = F.from_json("value", S.DECISIONS)
    rec = sjobs.decision_records(dec).select("key", value.alias("v"))
    return _round(rec.select("key", "v.event_id", "v.card_id", "v.amount", "v.fraud_probability", "v.decision", "v.model_version"),
                  ["amount", "fraud_probability"])


def _label_join(spark, sf_dir, horizon):
    configure(spark)
    root = scratch_path(spark, "stream-labels")
    pay = _pay(spark, sf_dir)
    (fixtures.prediction_log(pay).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "fraud_probability")
     .write.mode("overwrite").parquet(f"{root}/preds"))
    (fixtures.labels_log(pay).select(F.col("event_id").alias("l_event_id"), "is_fraud",
                                     F.col("label_timestamp").cast("timestamp").alias("label_timestamp"))
     .write.mode("overwrite").parquet(f"{root}/labels"))
    p = spark.readStream.schema(spark.read.parquet(f"{root}/preds").schema).parquet(f"{root}/preds")
    lab = spark.readStream.schema(spark.read.parquet(f"{root}/labels").schema).parquet(f"{root}/labels")
    _run_available_now(sjobs.label_join_stream(p, lab, horizon), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


def _label_rows(out):
    return _round(out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "fraud_probability", "is_fraud",
                             F.col("label_timestamp").cast("timestamp_ntz").alias("label_timestamp")),
                  ["fraud_probability"])


@register("stream_label_join")
def q_stream_label_join(spark, sf_dir):
    """JOIN-6: prediction stream ⟕ label stream (watermarks 10 min, label within 150 min of the prediction): matched pairs, and
    with nulls each prediction whose horizon the watermark has passed."""
    return _label_rows(_label_join(spark, sf_dir, "150 minutes"))


@register("stream_label_outcomes")
def q_stream_label_outcomes(spark, sf_dir):
    """JOIN-6: the same join within the evaluation's label delay (60 min, LABEL_DELAY_MINUTES; half of the labels
    here come later): matched pairs, and with nulls each prediction whose horizon the watermark has passed."""
    return _label_rows(_label_join(spark, sf_dir, "60 minutes"))


# ---------------------------------------------------------------- training

_MODELS: dict[tuple, str] = {}


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    """WIN-5: deterministic stratified 80/20 split of the training frame (md5 order per class)."""
    frame = tr.training_frame(_pay(spark, sf_dir))
    return stratified_split(frame).select("event_id", "is_fraud", "is_test")


@register("class_weight")
def q_class_weight(spark, sf_dir):
    """AGG-10: neg, pos and scale_pos_weight of the training split."""
    frame = stratified_split(tr.training_frame(_pay(spark, sf_dir)))
    return _round(metrics.class_weight(frame.where(~F.col("is_test"))), ["scale_pos_weight"])


@register("training_frame")
def q_training_frame(spark, sf_dir):
    """ML-1: labelled payments at the 5-minute window end with both feature views, missing → 0."""
    return _round(tr.training_frame(_pay(spark, sf_dir)), ["amount", "amount_sum_1m", "avg_transaction_amount_5m"])


def _trained(spark, sf_dir):
    key = (sf_dir, spark.sparkContext.applicationId)
    if key not in _MODELS:
        model, met = tr.train(_pay(spark, sf_dir))
        path = scratch_path(spark, "model")
        tr.save_model(model, path)
        met = met.checkpoint(eager=True)
        tr.log_run(met, f"{checkpoint_root_path(spark)}/payrisk/runs", "train", tr.asdict(tr.TrainParams()))
        _MODELS[key] = (path, met)
    return _MODELS[key]


def checkpoint_root_path(spark):
    from payrisk.session import checkpoint_root

    return checkpoint_root(spark).rstrip("/")


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    """ML-1/2/5 + AGG-10 + SNK-8: GBT (300 trees, depth 6, step 0.05, subsample 0.9) with class
    weights on the stratified training split; test-split metrics (also logged to the runs table)."""
    _, met = _trained(spark, sf_dir)
    return met


@register("eval_delayed_gbt")
def q_eval_delayed_gbt(spark, sf_dir):
    """ML-9 + ML-4: delayed-label evaluation with the trained GBT model (reloaded from disk)."""
    path, _ = _trained(spark, sf_dir)
    s = ev.evaluate_delayed(_pay(spark, sf_dir), model=tr.load_model(path), version="candidate")
    return _round(s, ["precision", "recall", "pr_auc", "psi_amount", "psi_txn_count_1m"])


@register("gbt_test_scores")
def q_gbt_test_scores(spark, sf_dir):
    """ML-4 + ML-6: the saved model reloaded and applied to the test split; P(fraud) and decision."""
    path, _ = _trained(spark, sf_dir)
    model = tr.load_model(path)
    frame = stratified_split(tr.training_frame(_pay(spark, sf_dir)))
    from payrisk.operators.score import score_model

    s = score_model(frame.where(F.col("is_test")), model, "candidate")
    return _round(s.select("event_id", "is_fraud", "fraud_probability", "decision"), ["fraud_probability"])


#: Fewer trees than a production fit (300 at rate 0.05): each level of a tree is a job of its own.
BOOST = tr.TrainParams(booster="hist", n_estimators=20, learning_rate=0.3)


@register("boost_first_gains")
def q_boost_first_gains(spark, sf_dir):
    """ML-2: the first tree's root: sums and gain (L2 1.0) of every cut of every feature over the weighted training split."""
    frame = stratified_split(tr.training_frame(_pay(spark, sf_dir))).where(~F.col("is_test")).checkpoint(eager=True)
    rows = boosting.with_bins(tr.weighted(frame), boosting.feature_cuts(frame, S.FEATURE_ORDER, 32))
    hist = boosting.histograms(boosting.gradients(rows, "is_fraud", "weight", F.lit(0.0)), F.lit(0))
    names = F.array(*map(F.lit, S.FEATURE_ORDER))
    gains = boosting.split_gains(hist, 1.0).withColumn("feature_name", F.get(names, F.col("feature")))
    return gains.select("feature_name", F.col("bin").cast("bigint").alias("bin"), "gl", "hl", "gt", "ht", round6(F.col("gain")).alias("gain"))


def _boosted(spark, sf_dir):
    key = ("hist", sf_dir, spark.sparkContext.applicationId)
    if key not in _MODELS:
        model, met = tr.train(_pay(spark, sf_dir), BOOST)
        path = tr.save_model(model, scratch_path(spark, "model-hist"))
        _MODELS[key] = (path, met.checkpoint(eager=True))
    return _MODELS[key]


@register("train_boosted")
def q_train_boosted(spark, sf_dir):
    """ML-1/2/5 + AGG-10: second-order histogram boosting (20 trees, depth 6, rate 0.3, row and column draws 0.9, L2 1.0,
    Hessian child weight 1.0) on the weighted training split; test-split metrics."""
    return _boosted(spark, sf_dir)[1]


@register("boosted_test_scores")
def q_boosted_test_scores(spark, sf_dir):
    """ML-4 + ML-6: the saved booster reloaded and applied to the test split; P(fraud) and decision."""
    from payrisk.operators.score import score_model

    model = tr.load_model(_boosted(spark, sf_dir)[0])
    frame = stratified_split(tr.training_frame(_pay(spark, sf_dir)))
    s = score_model(frame.where(F.col("is_test")), model, "candidate")
    return _round(s.select("event_id", "is_fraud", "fraud_probability", "decision"), ["fraud_probability"])


# ---------------------------------------------------------------- snapshots, logs, enrichment

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


@register("snapshot_payments")
def q_snapshot_payments(spark, sf_dir):
    """SRC-3 + FLT-6 + PRJ-6: bounded snapshot of the payment topic (landed JSON) → payments_v1 rows."""
    configure(spark)
    root = scratch_path(spark, "snapshot-payments")
    fixtures.land_json_lines(fixtures.payment_json_lines(_pay(spark, sf_dir)), root)
    snap = logs.snapshot_payments(spark.read.text(root))
    return _round(snap, ["amount"])


@register("snapshot_features")
def q_snapshot_features(spark, sf_dir):
    """SRC-4: feature-topic snapshot from earliest; unparseable records skipped."""
    configure(spark)
    root = scratch_path(spark, "snapshot-features")
    f1 = velocity.card_velocity_1m(_pay(spark, sf_dir)).withColumn("created_timestamp", F.col("event_timestamp"))
    good = f1.select(F.to_json(F.struct(
        "card_id", F.date_format("event_timestamp", _ISO).alias("event_timestamp"),
        F.date_format("created_timestamp", _ISO).alias("created_timestamp"),
        "txn_count_1m", "amount_sum_1m")).alias("value"))
    # a damaged second copy of multi-row windows, and lines that are not JSON
    bad = f1.where(F.col("txn_count_1m") >= 2).select(F.to_json(F.struct(
        "card_id", F.date_format("event_timestamp", _ISO).alias("event_timestamp"),
        F.lit("n/a").alias("amount_sum_1m"))).alias("value"))
    junk = f1.where(F.col("txn_count_1m") >= 2).select(F.concat(F.lit("{broken "), F.col("card_id")).alias("value"))
    good.unionByName(bad).unionByName(junk).write.mode("overwrite").text(root)
    snap = logs.snapshot_features(spark.read.text(root))
    return _round(snap.select("card_id", "event_timestamp", "txn_count_1m", "amount_sum_1m"), ["amount_sum_1m"])


@register("eval_event_id_jsonl")
def q_eval_event_id_jsonl(spark, sf_dir):
    """SRC-8 + ML-10: both logs written as JSON lines with blank and broken lines, scanned
    tolerantly and evaluated; equals the evaluation of the clean logs."""
    configure(spark)
    root = scratch_path(spark, "jsonl-logs")
    pay = _pay(spark, sf_dir)
    log = fixtures.prediction_log(pay).withColumn("ts", F.date_format("ts", _ISO)) \
        .withColumn("event_ts", F.date_format("event_ts", _ISO)).withColumn("ingest_ts", F.date_format("ingest_ts", _ISO))
    lab = fixtures.labels_log(pay).withColumn("label_timestamp", F.date_format("label_timestamp", _ISO))
    for name, df in (("preds", log), ("labels", lab)):
        lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
        noise = df.limit(0).sparkSession.createDataFrame([("",), ("{not json",), ("   ",)], "value string")
        lines.unionByName(noise).write.mode("overwrite").text(f"{root}/{name}")
    s = ev.evaluate_event_id(logs.read_prediction_log(spark, f"{root}/preds"),
                             logs.read_labels_log(spark, f"{root}/labels"), allow_partial=True)
    return _round(s, _SUMMARY_D)


@register("enriched_events")
def q_enriched_events(spark, sf_dir):
    """EXT-4 + JOIN-5: every payment with the 1m and 5m features current at its event time (no scoring)."""
    pay = _pay(spark, sf_dir)
    ent = pay.select("event_id", "card_id", "event_timestamp", "amount")
    return _round(pit.point_in_time_join(ent, velocity_views(pay)), ["amount", "amount_sum_1m", "avg_transaction_amount_5m"])


@register("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """STR-8: payment stream with repeated deliveries (ids mod 13 = 0 sent twice); duplicates dropped
    within a 10-minute watermark."""
    configure(spark)
    root = scratch_path(spark, "stream-dedupe")
    pay = _pay(spark, sf_dir)
    lines = fixtures.payment_json_lines(pay)
    again = fixtures.payment_json_lines(pay.where(F.pmod(F.col("event_id").cast("long"), F.lit(13)) == 0))
    fixtures.land_json_lines(lines.unionByName(again), f"{root}/in")
    stream = ssrc.decode_payments(ssrc.json_lines_source(spark, f"{root}/in"))
    _run_available_now(sjobs.drop_duplicate_deliveries(stream).select("event_id", "card_id", "amount"),
                       f"{root}/out", f"{root}/ckpt")
    return _round(spark.read.parquet(f"{root}/out"), ["amount"])


@register("decisions_large")
def q_decisions_large(spark, sf_dir):
    """ML-3 + PRJ-15 over the lineitem ⨝ orders payments (large amounts): decision counts,
    mean probability and missing-feature events per decision."""
    from payrisk.plans.score import score_payments

    s = score_payments(_pay(spark, sf_dir, large=True))
    return _round(s.groupBy("decision").agg(
        F.count(F.lit(1)).alias("n"), F.avg("fraud_probability").alias("avg_probability"),
        F.sum((F.size("missing_features") > 0).cast("int")).cast("long").alias("n_with_missing")),
        ["avg_probability"])


@register("stream_geo_change_5m")
def q_stream_geo_change_5m(spark, sf_dir):
    """EXT-3 (stream): cards seen in more than one country per 5-minute window, 5 s watermark."""
    from payrisk.streaming.features import geo_change_stream

    root = scratch_path(spark, "stream-geo")
    fixtures.land_json_lines(fixtures.payment_json_lines(_pay(spark, sf_dir)), f"{root}/in")
    stream = ssrc.decode_payments(ssrc.json_lines_source(spark, f"{root}/in"))
    _run_available_now(geo_change_stream(stream), f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out")
    return out.select("card_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                      "geo_change_flag_5m")


@register("stream_geo_change")
def q_stream_geo_change(spark, sf_dir):
    """EXT-3 (stream, exact): every event with 1 if its card was in another country within 5 minutes before, by an interval
    self-join and one flag per event; the events that the final watermark (5 s late) closes."""
    from payrisk.streaming.features import geo_flags_stream

    configure(spark)
    root = scratch_path(spark, "stream-geo-exact")
    _pay(spark, sf_dir).select("event_id", "card_id", "country", F.col("event_timestamp").cast("timestamp").alias("event_time")).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    now, again = (spark.readStream.schema(schema).parquet(f"{root}/in") for _ in range(2))
    _run_available_now(geo_flags_stream(now, again), f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out")
    return out.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@register("stream_enriched")
def q_stream_enriched(spark, sf_dir):
    """JOIN-5 + EXT-4 as of the event, on streams: payments joined to the stream of both views' feature rows (interval join, then
    the newest row per event and view); the events that the final watermark closes."""
    from payrisk.streaming.features import enriched_stream

    configure(spark)
    root = scratch_path(spark, "stream-enriched")
    pay = _pay(spark, sf_dir)
    stamp = F.col("event_timestamp").cast("timestamp").alias("event_timestamp")
    pay.where("card_id is not null and event_timestamp is not null").select("event_id", "card_id", stamp, "amount").write.parquet(f"{root}/events")
    views = {v.name: v for v in velocity_views(pay)}
    tagged = [v.df.select("card_id", stamp, stamp.alias("created_timestamp"), F.lit(name).alias("view"), *v.fields) for name, v in views.items()]
    tagged[0].unionByName(tagged[1], allowMissingColumns=True).write.parquet(f"{root}/features")
    events, features = (spark.readStream.schema(spark.read.parquet(f"{root}/{t}").schema).parquet(f"{root}/{t}") for t in ("events", "features"))
    joined = enriched_stream(events, features, {name: (list(v.fields), v.ttl_seconds) for name, v in views.items()})
    _run_available_now(joined, f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out").withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
    return _round(out, ["amount", "amount_sum_1m", "avg_transaction_amount_5m"])
