"""Command-line jobs: ``python -m payrisk.cli <job> [options]``.

One sub-command per batch or stream job of the reference, with the same
defaults; every option can also come from the environment variable of the
same upper-case name.  Each job builds a plan from library functions and
writes its outputs; no job collects data to the driver beyond one-row
summaries.

  ingest            CSV → payments table + JSON report (fails after writing on errors)
  features          payments → 1-minute and 5-minute card velocity tables
  train             payments → GBT model, metrics row in a runs table
  evaluate-delayed  payments (+ model or fallback) → metrics and drift row
  evaluate-eventid  prediction log + label log → summary, quality gate (non-zero exit on failure)
  drift             payments, 1m features, prediction log → PSI report
  validate-stream   raw payment stream → valid rows + dead-letter records
  velocity-stream   payment stream → 1-minute velocity records
  push-online       feature stream → latest-per-card table
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from payrisk import schemas as S


def _env(name: str, default):
    v = os.environ.get(name.upper())
    if v is None:
        return default
    if isinstance(default, bool):
        return v == "1"
    return type(default)(v) if default is not None else v


def _session(streaming: bool = False) -> SparkSession:
    from payrisk.session import configure

    spark = SparkSession.builder.appName("payrisk").getOrCreate()
    if streaming and not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        # windowed state grows with the number of active cards: keep it off-heap in RocksDB
        spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return configure(spark)


def _print(row: dict) -> None:
    print(json.dumps({k: (v if not hasattr(v, "isoformat") else v.isoformat()) for k, v in row.items()},
                     sort_keys=True, default=str))


def cmd_ingest(a) -> int:
    from payrisk.plans.ingest import ingest_csv, write_ingest

    spark = _session()
    pay, rep = ingest_csv(spark, a.input_csv, a.start_time_utc, a.n_cards, a.n_merchants, a.seed)
    try:
        row = write_ingest(pay, rep, a.output_parquet, a.output_report_json)
    except ValueError as e:
        print(str(e), file=sys.stderr)
        return 1
    _print(row)
    return 0


def cmd_features(a) -> int:
    from pyspark.sql import functions as F

    from payrisk.operators.velocity import card_velocity_1m, card_velocity_5m

    spark = _session()
    pay = spark.read.parquet(a.payments_path)
    card_velocity_1m(pay, F.current_timestamp()).write.mode("overwrite").parquet(a.out_1m)
    card_velocity_5m(pay, F.current_timestamp()).write.mode("overwrite").parquet(a.out_5m)
    return 0


def cmd_train(a) -> int:
    from payrisk.plans.train import TrainParams, asdict, log_run, save_model, train

    spark = _session()
    params = TrainParams(test_size=a.test_size, seed=a.seed, n_estimators=a.n_estimators, max_depth=a.max_depth,
                         learning_rate=a.learning_rate, subsample=a.subsample, colsample_bytree=a.colsample_bytree,
                         threshold=a.threshold, reg_lambda=a.reg_lambda, min_child_weight=a.min_child_weight, max_bins=a.max_bins,
                         booster=a.booster)
    model, metrics = train(spark.read.parquet(a.payments_path), params)
    save_model(model, a.model_path)
    log_run(metrics, a.runs_path, "train", asdict(params))
    _print(metrics.first().asDict())
    return 0


def _count(x) -> int | None:
    """A row count from the command line or the environment; none means all rows."""
    return int(x) if x not in (None, "") else None


def cmd_evaluate_delayed(a) -> int:
    from payrisk.plans.evaluate import evaluate_delayed
    from payrisk.plans.train import load_model_or_fallback

    spark = _session()
    model, version = load_model_or_fallback(a.model_path)
    out = evaluate_delayed(spark.read.parquet(a.payments_real_path), a.label_delay_minutes, a.threshold, _count(a.max_rows),
                           model=model, version=version)
    row = dict(out.first().asDict(), model_version=version)
    _print(row)
    _log_evaluation(spark, a, "evaluate_delayed", row)
    return 0 if row["status"] == "ok" else 1


def _log_evaluation(spark, a, name: str, row: dict) -> None:
    """SNK-8: one row of the runs table, when ``--runs_path`` is given."""
    from payrisk.plans.train import log_run

    if a.runs_path:
        numbers = {k: float(v) for k, v in row.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
        options = {k: v for k, v in vars(a).items() if k not in ("fn", "job")}
        log_run(spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{k} double" for k in numbers)), a.runs_path, name, options)


def cmd_evaluate_eventid(a) -> int:
    from payrisk.plans.evaluate import EvaluationError, enforce_row, evaluate_event_id, quality_gate
    from payrisk.sources.logs import read_labels_log, read_prediction_log

    spark = _session()
    preds = read_prediction_log(spark, a.prediction_log_path)
    labels = read_labels_log(spark, a.labels_log_path)
    summary = evaluate_event_id(preds, labels, a.label_grace_minutes, a.threshold, a.allow_partial, _count(a.max_rows))
    gated = quality_gate(summary, a.min_join_rate, a.min_precision, a.min_recall, a.min_pr_auc)
    row = gated.first().asDict()
    _print(row)
    _log_evaluation(spark, a, "evaluate_eventid", row)
    try:
        enforce_row(row)
    except EvaluationError as e:
        print(str(e), file=sys.stderr)
        return 1
    return 0


def cmd_drift(a) -> int:
    from payrisk.operators.topk import tail_by_time
    from payrisk.plans.drift import drift_report
    from payrisk.sources.logs import read_prediction_log

    spark = _session()
    from payrisk.plans.evaluate import as_timestamp

    log = read_prediction_log(spark, a.prediction_log_path)
    log = log.withColumn("ts", as_timestamp(log, "ts"))
    recent = tail_by_time(log, a.recent_rows, "ts", ("event_id",))
    rep = drift_report(spark.read.parquet(a.payments_path).select("amount"),
                       spark.read.parquet(a.offline_features_path).select("txn_count_1m", "amount_sum_1m"), recent)
    for r in rep.collect():  # three rows
        _print(r.asDict())
    return 0


def cmd_validate_stream(a) -> int:
    from payrisk.streaming import jobs, sources

    spark = _session(streaming=True)
    src = (sources.kafka_source(spark, a.bootstrap, a.topic, "earliest") if a.bootstrap
           else sources.file_message_source(spark, a.input_path))
    out = {"kafka.bootstrap.servers": a.bootstrap, "topic": a.dlq_topic} if a.bootstrap and a.dlq_topic else None
    q = jobs.start_validation(src, a.valid_path, a.dlq_path, a.checkpoint, dlq_topic=out)
    q.awaitTermination()
    return 0


def cmd_velocity_stream(a) -> int:
    from payrisk.streaming import sources
    from payrisk.streaming.features import start_card_velocity

    spark = _session(streaming=True)
    src = (sources.kafka_source(spark, a.bootstrap, a.topic, "latest") if a.bootstrap
           else sources.json_lines_source(spark, a.input_path))
    if a.bootstrap and a.output_topic:
        q = start_card_velocity(sources.decode_payments(src), a.output_topic, a.checkpoint, fmt="kafka",
                                options={"kafka.bootstrap.servers": a.bootstrap})
    else:
        q = start_card_velocity(sources.decode_payments(src), a.output_path, a.checkpoint)
    q.awaitTermination()
    return 0


def cmd_score_stream(a) -> int:
    from payrisk.plans.train import load_model_or_fallback
    from payrisk.streaming import jobs, sources

    spark = _session(streaming=True)
    limit = _count(a.max_offsets)
    src = (sources.kafka_source(spark, a.bootstrap, a.topic, "latest", limit) if a.bootstrap
           else sources.json_lines_source(spark, a.input_path))
    model, version = load_model_or_fallback(a.model_path, a.allow_fallback_model)
    out = {"kafka.bootstrap.servers": a.bootstrap, "topic": a.output_topic} if a.bootstrap and a.output_topic else None
    q = jobs.start_scoring(sources.decode_requests(src), a.latest_1m_path, a.latest_5m_path, a.decisions_path, a.log_path,
                           a.errors_path, a.checkpoint, {"availableNow": True} if a.once else None, threshold=a.threshold,
                           model=model, version=version, apply_ttl=a.apply_ttl, bounded_requests=bool(a.bootstrap) and limit is not None, decisions_topic=out)
    q.awaitTermination()
    return 0


def _snapshot(a, spark):
    from payrisk.streaming import sources

    if a.bootstrap:
        return sources.kafka_snapshot(spark, a.bootstrap, a.topic, _count(a.starting_ms), _count(a.ending_ms))
    return spark.read.text(a.input_path)


def cmd_snapshot_payments(a) -> int:
    from payrisk.sources.logs import snapshot_payments

    snapshot_payments(_snapshot(a, _session())).write.mode("overwrite").parquet(a.output_path)
    return 0


def cmd_snapshot_features(a) -> int:
    from payrisk.sources.logs import FEATURE_VIEWS, snapshot_features

    snapshot_features(_snapshot(a, _session()), FEATURE_VIEWS[a.view]).write.mode("overwrite").parquet(a.output_path)
    return 0


def cmd_online_read(a) -> int:
    from payrisk.streaming.online import read_card, read_online

    spark = _session(streaming=True)
    if a.published_path:
        for row in read_card(spark, a.published_path, a.card_id).toJSON().collect():
            print(row)
        return 0
    table = read_online(spark, a.table_path)
    if table is None:
        print("online_table_empty")
        return 1
    for row in table.where(table.card_id == a.card_id).toJSON().collect():  # one row per card
        print(row)
    return 0


def cmd_publish_online(a) -> int:
    """The online table in files bucketed by card, for lookups of one card (``online-read --published_path``)."""
    from payrisk.streaming.online import publish_online

    if publish_online(_session(streaming=True), a.table_path, a.published_path, a.buckets) is None:
        print("online_table_empty")
        return 1
    return 0


def cmd_update_features(a) -> int:
    """Feature views kept up with deliveries: windows that new payment files touch are computed again."""
    from payrisk.streaming.incremental import start_views

    spark = _session(streaming=True)
    schema = spark.read.parquet(a.payments_path).schema
    trigger = {"availableNow": True} if a.once else {"processingTime": S.CHECKPOINT_INTERVAL}
    start_views(spark, a.payments_path, schema, a.output_path, a.checkpoint, trigger).awaitTermination()
    return 0


def cmd_push_online(a) -> int:
    """Feature records of a topic (at most ONLINE_PUSH_MAX_ROWS a micro-batch) or landed feature files, kept as the newest row per card."""
    from payrisk.sources.logs import FEATURE_VIEWS, snapshot_features
    from payrisk.streaming import online, sources

    spark = _session(streaming=True)
    if a.bootstrap:
        messages = sources.kafka_source(spark, a.bootstrap, a.topic, "earliest", S.ONLINE_PUSH_MAX_ROWS)
        features = snapshot_features(messages, FEATURE_VIEWS[a.view])
    else:
        schema = spark.read.parquet(a.input_path).schema
        features = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(a.input_path)
    out = {"kafka.bootstrap.servers": a.bootstrap, "topic": a.output_topic} if a.bootstrap and a.output_topic else None
    online.start_online(features, a.table_path, {"availableNow": True} if a.once else None, topic=out).awaitTermination()
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="payrisk")
    sub = p.add_subparsers(dest="job", required=True)

    def add(name, fn, opts):
        sp = sub.add_parser(name)
        for flag, default in opts:
            kind = type(default) if default is not None and not isinstance(default, bool) else str
            if isinstance(default, bool):
                sp.add_argument(f"--{flag}", type=lambda v: v in ("1", "true", "True"), default=_env(flag, default))
            else:
                sp.add_argument(f"--{flag}", type=kind, default=_env(flag, default))
        sp.set_defaults(fn=fn)

    add("ingest", cmd_ingest, [("input_csv", None), ("output_parquet", None), ("output_report_json", None),
                               ("start_time_utc", S.INGEST_START_TIME), ("n_cards", S.INGEST_N_CARDS),
                               ("n_merchants", S.INGEST_N_MERCHANTS), ("seed", 7)])
    add("features", cmd_features, [("payments_path", None), ("out_1m", None), ("out_5m", None)])
    add("train", cmd_train, [("payments_path", None), ("model_path", None), ("runs_path", None),
                             ("test_size", 0.2), ("seed", 42), ("n_estimators", 300), ("max_depth", 6),
                             ("learning_rate", 0.05), ("subsample", 0.9), ("colsample_bytree", 0.9),
                             ("reg_lambda", 1.0), ("min_child_weight", 1.0), ("max_bins", 256), ("booster", "hist"),
                             ("threshold", S.DECISION_THRESHOLD)])
    add("evaluate-delayed", cmd_evaluate_delayed, [("payments_real_path", None), ("model_path", None),
                                                   ("label_delay_minutes", S.LABEL_DELAY_MINUTES),
                                                   ("threshold", S.DECISION_THRESHOLD), ("max_rows", None), ("runs_path", None)])
    add("evaluate-eventid", cmd_evaluate_eventid, [
        ("prediction_log_path", None), ("labels_log_path", None), ("threshold", S.DECISION_THRESHOLD),
        ("label_grace_minutes", S.LABEL_GRACE_MINUTES), ("allow_partial", False), ("max_rows", None), ("runs_path", None),
        ("min_join_rate", -1.0), ("min_precision", -1.0), ("min_recall", -1.0), ("min_pr_auc", -1.0)])
    add("drift", cmd_drift, [("payments_path", None), ("offline_features_path", None),
                             ("prediction_log_path", None), ("recent_rows", S.RECENT_ROWS)])
    add("validate-stream", cmd_validate_stream, [("bootstrap", None), ("topic", "payments.v1"), ("input_path", None),
                                                 ("valid_path", None), ("dlq_path", None), ("dlq_topic", None), ("checkpoint", None)])
    add("velocity-stream", cmd_velocity_stream, [("bootstrap", None), ("topic", "payments.v1"), ("input_path", None),
                                                 ("output_path", None), ("output_topic", None), ("checkpoint", None)])
    add("score-stream", cmd_score_stream, [
        ("bootstrap", None), ("topic", "payments.v1"), ("input_path", None), ("latest_1m_path", None), ("latest_5m_path", None),
        ("decisions_path", None), ("log_path", None), ("errors_path", None), ("checkpoint", None), ("output_topic", None),
        ("model_path", None), ("allow_fallback_model", True), ("threshold", S.DECISION_THRESHOLD), ("apply_ttl", False),
        ("max_offsets", None), ("once", False)])
    for name, fn, topic in (("snapshot-payments", cmd_snapshot_payments, "payments.v1"), ("snapshot-features", cmd_snapshot_features, "features.card.v1")):
        add(name, fn, [("bootstrap", None), ("topic", topic), ("input_path", None), ("starting_ms", None), ("ending_ms", None), ("output_path", None)]
            + [("view", "1m")] * (name == "snapshot-features"))
    add("online-read", cmd_online_read, [("table_path", None), ("published_path", None), ("card_id", None)])
    add("publish-online", cmd_publish_online, [("table_path", None), ("published_path", None), ("buckets", S.ONLINE_BUCKETS)])
    add("update-features", cmd_update_features, [("payments_path", None), ("output_path", None), ("checkpoint", None), ("once", True)])
    add("push-online", cmd_push_online, [("bootstrap", None), ("topic", "features.card_velocity_1m.v2"), ("view", "1m"), ("input_path", None), ("table_path", None),
                                         ("output_topic", None), ("once", False)])
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
