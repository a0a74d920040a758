"""Metrics, evaluation and gate: hand cases and a pure-Python average precision."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from payrisk.operators.metrics import average_precision, classification_summary
from payrisk.operators.topk import tail_by_time
from payrisk.plans import evaluate as ev


def ap_reference(y, s):
    """Average precision by its definition over distinct scores (descending)."""
    pairs = sorted(zip(s, y), key=lambda t: -t[0])
    pos = sum(y)
    i, tp, n, ap = 0, 0, 0, 0.0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        block = pairs[i:j]
        btp = sum(b[1] for b in block)
        tp += btp
        n += len(block)
        ap += btp / pos * (tp / n)
        i = j
    return ap


def _scores(spark, y, s):
    return spark.createDataFrame(list(zip(y, s)), "is_fraud int, fraud_probability double")


def test_ap_ties_and_partitions(spark):
    import random

    rnd = random.Random(3)
    y = [rnd.random() < 0.3 for _ in range(3000)]
    s = [round(rnd.random() * (0.5 + 0.5 * t), 2) for t in y]  # many ties
    y = [int(t) for t in y]
    exp = ap_reference(y, s)
    df = _scores(spark, y, s)
    for parts in (1, 8, 50):
        got = average_precision(df.repartition(parts)).first()["pr_auc"]
        assert got == pytest.approx(exp, rel=1e-12), parts


def test_ap_one_class_is_nan(spark):
    import math

    got = average_precision(_scores(spark, [0, 0, 0], [0.1, 0.2, 0.3])).first()["pr_auc"]
    assert math.isnan(got)


def test_zero_division(spark):
    r = classification_summary(_scores(spark, [1, 0, 1], [0.1, 0.2, 0.3]), threshold=0.9).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["tp"] == 0


def test_tail_by_time_exact(spark):
    rows = [(str(i), datetime(2024, 1, 1) + timedelta(seconds=(i * 37) % 500)) for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id string, ts timestamp_ntz")
    exp = sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)[:123]
    got = [(r["event_id"], r["ts"]) for r in tail_by_time(df.repartition(7), 123, "ts", ("event_id",)).collect()]
    assert sorted(got) == sorted(exp)
    assert tail_by_time(df, 10 ** 6, "ts").count() == 2000


def _logs(spark):
    t = datetime(2024, 1, 1, 10)
    preds = spark.createDataFrame([
        ("e1", t.isoformat() + "Z", "0.9"), ("e2", t.isoformat() + "Z", "0.1"),
        ("e3", (t + timedelta(minutes=1)).isoformat() + "Z", "0.7"), ("e3", (t + timedelta(minutes=2)).isoformat() + "Z", "0.2"),
        ("e4", t.isoformat() + "Z", "abc"), (None, t.isoformat() + "Z", "0.5"),
    ], "event_id string, ts string, fraud_probability string")
    labels = spark.createDataFrame([
        ("e1", "1", (t + timedelta(hours=1)).isoformat() + "Z"),
        ("e2", "1", (t + timedelta(hours=1)).isoformat() + "Z"),
        ("e2", "0", (t + timedelta(hours=2)).isoformat() + "Z"),  # re-label wins
        ("e9", "x", (t + timedelta(hours=3)).isoformat() + "Z"),  # bad label -> 0
    ], "event_id string, is_fraud string, label_timestamp string")
    return preds, labels


def test_relabel_partial_and_strict(spark):
    preds, labels = _logs(spark)
    s = ev.evaluate_event_id(preds, labels, allow_partial=True, materialize=False).first()
    assert s["n_predictions_total"] == 3 and s["n_labels_total"] == 3
    assert s["n_eval"] == 2 and s["missing_joins"] == 1
    assert s["join_rate"] == pytest.approx(2 / 3)
    assert s["precision"] == 1.0 and s["recall"] == 1.0 and s["pr_auc"] == 1.0
    strict = ev.evaluate_event_id(preds, labels, allow_partial=False, materialize=False)
    with pytest.raises(ev.EvaluationError, match="missing_joins"):
        ev.enforce(strict)


def test_gate_off_and_failures(spark):
    preds, labels = _logs(spark)
    s = ev.evaluate_event_id(preds, labels, allow_partial=True, materialize=False)
    assert ev.quality_gate(s).first()["gate_passed"] is True
    g = ev.quality_gate(s, min_join_rate=0.99).first()
    assert g["gate_passed"] is False and g["gate_failures"].startswith("join_rate 0.666667 < 0.990000")


def test_heuristic_values(spark):
    from payrisk.functions.columns import heuristic_probability

    df = spark.createDataFrame([(0.0, 0, 0), (10000.0, 0, 0)], "amount double, txn_count_1m long, txn_count_5m long")
    got = [r[0] for r in df.select(heuristic_probability()).collect()]
    assert got[0] == pytest.approx(0.0024726, abs=1e-7) and got[1] == 0.999


def test_eval_from_plain_dictionaries(spark):
    """ML-10 on the driver table: newest label and prediction of every event kept in dictionaries."""
    from datetime import timedelta

    from payrisk.plans.registry import QUERIES
    from payrisk.sources import fixtures

    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    label, scored = {}, {}
    for r in fixtures.labels_log(pay).collect():
        label[r["event_id"]] = max(label.get(r["event_id"], (r["label_timestamp"], r["is_fraud"])), (r["label_timestamp"], r["is_fraud"]))
    for r in fixtures.prediction_log(pay).collect():
        if r["event_id"] is not None and r["fraud_probability"] is not None:
            scored[r["event_id"]] = max(scored.get(r["event_id"], (r["ts"], r["fraud_probability"])), (r["ts"], r["fraud_probability"]))
    until = max(t for t, _ in label.values()) - timedelta(minutes=5)
    due = {e: p for e, (t, p) in scored.items() if t <= until}
    known = [e for e in due if e in label]
    got = QUERIES["eval_event_id"](spark, "/root/testdata/sf0.001").first()
    assert (got["n_eval"], got["missing_joins"]) == (len(known), len(due) - len(known))
    assert got["pr_auc"] == pytest.approx(ap_reference([label[e][1] for e in known], [due[e] for e in known]), abs=1e-6)


def test_split_partition_independent(spark):
    """WIN-5: same split for 1, 4 and 50 shuffle partitions and input partitionings."""
    from payrisk.operators.split import stratified_split

    df = spark.range(5000).select(F.col("id").cast("string").alias("event_id"),
                                  (F.col("id") % 7 == 0).cast("int").alias("is_fraud"))
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in (1, 4, 50):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            s = stratified_split(df.repartition(parts), prefix_hex=2)
            got.append(sorted(r["event_id"] for r in s.where("is_test").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert got[0] == got[1] == got[2]
    n_pos, n_neg = 715, 4285
    assert len(got[0]) == round(n_pos * 0.2) + round(n_neg * 0.2)


def test_python_model_hook(spark):
    """mapInPandas scoring hands the model its features in order and takes the second column."""
    import numpy as np

    from payrisk.operators.score import score_python_model

    def two_steps(x):  # a stump on amount with a nudge by the 5-minute count
        high = np.where(x[:, 4] > 900, 0.75, 0.125) + x[:, 2] / 1000
        return np.column_stack([1 - high, high])

    df = spark.range(500).select(
        F.col("id").cast("string").alias("event_id"), (F.col("id") % 7).alias("txn_count_1m"),
        (F.col("id") * 1.5).alias("amount_sum_1m"), (F.col("id") % 11).alias("txn_count_5m"),
        (F.col("id") * 0.3).alias("avg_transaction_amount_5m"), (F.col("id") * 4.0).alias("amount"))
    got = {int(r["event_id"]): r["fraud_probability"] for r in score_python_model(df, two_steps, "py").collect()}
    assert got == {i: pytest.approx((0.75 if i * 4 > 900 else 0.125) + i % 11 / 1000) for i in range(500)}
