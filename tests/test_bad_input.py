"""Ordinary bad input: NaN cells, numbers as text, missing ids, equal requests, far timestamps."""
import json
from datetime import datetime

from pyspark.sql import functions as F

from payrisk.functions.columns import try_double, try_label
from payrisk.operators import monitor
from payrisk.plans.evaluate import evaluate_delayed, evaluate_event_id
from payrisk.plans.ingest import ingest_csv, parse_start_time, write_ingest
from payrisk.sources import fixtures
from payrisk.sources.logs import read_prediction_log, snapshot_payments
from payrisk.streaming import jobs
from payrisk.streaming.features import geo_change_stream
from payrisk.streaming.sources import decode_payments, json_lines_source

EVENT = {"event_id": "e1", "card_id": "c1", "amount": 12.5, "event_ts": "2024-01-01T00:00:05Z", "ingest_ts": "2024-01-01T00:00:06Z", "is_fraud": 1, "country": "ES"}


def _messages(spark, events):
    return spark.createDataFrame([(json.dumps(e),) for e in events], "value string")


def test_coercions(spark):
    df = spark.createDataFrame([("NaN",), ("1e20",), ("1.9",), ("x",), (None,), ("-3",)], "s string")
    got = [tuple(r) for r in df.select(try_double("s"), try_label("s")).collect()]
    assert got == [(None, 0), (1e20, 0), (1.9, 1), (None, 0), (None, 0), (-3.0, -3)]


def test_csv_cells(spark, tmp_dir):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write("Time,V1,Amount,Class\n0,1,5.0,0\nNaN,1,5.0,0\n1,1,NaN,1\n2,1,7.0,NaN\n3,1,8.0,1e20\n4,1,-1,0\n")
    pay, rep = ingest_csv(spark, f"{tmp_dir}/x.csv")
    assert [(r["idx"], r["amount"], r["is_fraud"]) for r in pay.orderBy("idx").collect()] == [(0, 5.0, 0), (1, 7.0, 0), (2, 8.0, 0)]
    assert rep.count() == 1


def test_start_times():
    want = datetime.fromisoformat("2024-01-01T00:00:00+00:00")
    assert parse_start_time("2024-01-01T00:00:00Z") == parse_start_time("2024-01-01T02:00:00+02:00") == parse_start_time("2024-01-01T00:00:00") == want


def test_numbers_as_text(spark):
    events = [EVENT, EVENT | {"amount": "12.5", "is_fraud": "1"}, EVENT | {"amount": True, "is_fraud": True}, EVENT | {"amount": "NaN", "is_fraud": "x"}]
    got = [(r["amount"], r["is_fraud"]) for r in snapshot_payments(_messages(spark, events)).collect()]
    assert got == [(12.5, 1), (12.5, 1), (1.0, 1), (0.0, 0)]
    assert [(r["amount"], r["is_fraud"]) for r in decode_payments(_messages(spark, events)).collect()] == [(12.5, 1), (12.5, 1), (1.0, 1), (None, None)]


def test_scoring_fills_ids(spark, tmp_dir):
    events = [EVENT, EVENT | {"event_id": ""}, EVENT | {"event_id": None}, EVENT | {"event_id": None}, EVENT | {"card_id": ""}, EVENT | {"amount": -1}]
    batch = decode_payments(_messages(spark, events))
    roots = [f"{tmp_dir}/{n}" for n in ("decisions", "log", "errors")]
    jobs.score_batch(batch, 0, None, None, *roots)
    ids = [r["event_id"] for r in spark.read.parquet(f"{roots[0]}/*").collect()]
    assert len(ids) == 4 and len(set(ids)) == 4 and "e1" in ids
    assert sorted(r["reason"] for r in spark.read.parquet(f"{roots[2]}/*").collect()) == ["amount_invalid", "card_id_empty"]
    jobs.score_batch(batch, 0, None, None, *roots)  # a retried batch gives the same ids
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{roots[0]}/*").collect()) == sorted(ids)


def _run(stream, name, tmp_dir):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()


def _landed(spark, events, path):
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string").write.text(path)
    return decode_payments(json_lines_source(spark, path))


def test_events_without_id_are_no_duplicates(spark, tmp_dir):
    events = [EVENT, EVENT, EVENT | {"event_id": None}, EVENT | {"event_id": None}, EVENT | {"event_id": ""}]
    _run(jobs.drop_duplicate_deliveries(_landed(spark, events, f"{tmp_dir}/in")), "no_ids", tmp_dir)
    assert spark.table("no_ids").count() == 4


def test_geo_change_is_exact(spark, tmp_dir):
    pairs = [("ES", "KR"), ("CN", "IT"), ("ID", "PH"), ("KE", "LK"), ("US", "US"), ("US", None)]
    events = [EVENT | {"event_id": f"{i}{s}", "card_id": f"c{i}", "country": c} for i, p in enumerate(pairs) for s, c in enumerate(p)]
    events.append(EVENT | {"card_id": "late", "event_ts": "2024-01-02T00:00:05Z"})
    _run(geo_change_stream(_landed(spark, events, f"{tmp_dir}/in")), "geo", tmp_dir)
    got = {r["card_id"]: r["geo_change_flag_5m"] for r in spark.table("geo").collect()}
    assert [got[f"c{i}"] for i in range(len(pairs))] == [1, 1, 1, 1, 0, 0]


def test_far_timestamp(spark):
    at = [datetime(2024, 1, 1, 0, m) for m in (0, 1, 30)] + [datetime(9999, 12, 30, 5)]
    log = spark.createDataFrame([(t, "approve") for t in at], "ts timestamp_ntz, decision string")
    got = sorted(map(tuple, monitor.idle_gaps(log).collect()))
    assert [(a, b) for a, b, *_ in got] == [(datetime(2024, 1, 1, 0, 6), datetime(2024, 1, 1, 0, 29)), (datetime(2024, 1, 1, 0, 35), datetime(9999, 12, 30, 4, 59))]
    assert got[0][2:] == (24, datetime(2024, 1, 1, 0, 16), 14)
    alerts = log.groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("window_start")).agg((F.count("*") > 0).alias("alert"))
    assert monitor.with_firing(alerts).count() == 4


def test_empty_logs_are_named(spark):
    preds = spark.createDataFrame([("a", datetime(2024, 1, 1), 0.5)], "event_id string, ts timestamp_ntz, fraud_probability double")
    labels = spark.createDataFrame([("a", datetime(2024, 1, 1, 2), 1)], "event_id string, label_timestamp timestamp_ntz, is_fraud int")

    def status(p, lab, **kw):
        return evaluate_event_id(p, lab, materialize=False, **kw).first()["status"]

    assert status(preds, labels) == "ok"
    assert status(preds.limit(0), labels) == "no_predictions_found"
    assert status(preds, labels.limit(0)) == "no_labels_found"
    assert status(preds, labels, grace_minutes=600) == "no_eligible_predictions"
    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    assert evaluate_delayed(pay, delay_minutes=10**7, materialize=False).first()["status"] == "no_eligible_rows"


def test_ingest_report_file(spark, tmp_dir):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write("Time,Amount,Class\nx,1,0\n")
    pay, rep = ingest_csv(spark, f"{tmp_dir}/x.csv")
    write_ingest(pay, rep, f"{tmp_dir}/p", f"{tmp_dir}/r", fail_on_errors=False)
    row = json.loads(spark.read.text(f"{tmp_dir}/r").first()[0])
    assert list(row) == sorted(row) and row["amount_min"] is None and row["rows"] == 0 and row["generated_at_utc"].endswith("Z")


def test_prediction_log_keeps_missing_features(spark, tmp_dir):
    spark.createDataFrame([('{"event_id": "a", "missing_features": ["txn_count_1m"]}',), ('{"event_id": "b"}',)], "value string").write.text(f"{tmp_dir}/log")
    got = {r["event_id"]: r["missing_features"] for r in read_prediction_log(spark, f"{tmp_dir}/log").collect()}
    assert got == {"a": ["txn_count_1m"], "b": None}
