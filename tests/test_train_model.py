"""Training: a small fit, the same scores after save and load, metrics from the definition, the run row."""
import pytest
from pyspark.sql import functions as F

from payrisk.operators.score import score_model
from payrisk.operators.split import stratified_split
from payrisk.plans import train as tr
from payrisk.sources import fixtures


@pytest.fixture(scope="module")
def fitted(spark):
    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    params = tr.TrainParams(n_estimators=3, max_depth=2)
    model, metrics = tr.train(pay, params)
    frame = stratified_split(tr.training_frame(pay), "is_fraud", "event_id", params.test_size, params.seed).cache()
    return model, metrics.first().asDict(), frame


def test_same_scores_after_reload(spark, fitted, tmp_path):
    model, _, frame = fitted
    path = tr.save_model(model, str(tmp_path / "m"))
    loaded, version = tr.load_model_or_fallback(path)
    assert version == "m"
    a = score_model(frame, model, "x").select("event_id", "fraud_probability")
    b = score_model(frame, loaded, "x").select("event_id", "fraud_probability")
    assert a.exceptAll(b).count() == 0 and a.where("fraud_probability between 0 and 1").count() == frame.count()


def test_missing_model(spark, tmp_path):
    assert tr.load_model_or_fallback(None) == tr.load_model_or_fallback(str(tmp_path / "none")) == (None, "fallback")
    with pytest.raises(FileNotFoundError):
        tr.load_model_or_fallback(str(tmp_path / "none"), allow_fallback=False)
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception):  # noqa: B017 - what lies there is no model
        tr.load_model_or_fallback(str(tmp_path / "broken"))


def test_metrics_by_hand(fitted):
    model, got, frame = fitted
    rows = [(r["is_fraud"], r["fraud_probability"]) for r in score_model(frame.where("is_test"), model, "x").collect()]
    counts = {(y, p): sum(1 for a, b in rows if a == y and (b >= 0.5) == p) for y in (0, 1) for p in (False, True)}
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (counts[0, False], counts[0, True], counts[1, False], counts[1, True])
    assert got["n_test"] == len(rows)
    neg, pos = (frame.where(~F.col("is_test") & (F.col("is_fraud") == y)).count() for y in (0, 1))
    assert got["scale_pos_weight"] == pytest.approx(neg / max(pos, 1)) and got["n_train"] == neg + pos


def test_run_row(spark, fitted, tmp_path):
    _, got, _ = fitted
    metrics = spark.createDataFrame([(float(got["precision"]), 3)], "precision double, n_test long")
    tr.log_run(metrics, str(tmp_path / "runs"), "small", {"max_depth": 2})
    row = spark.read.parquet(str(tmp_path / "runs")).first()
    assert row["run_name"] == "small" and row["params"]["max_depth"] == "2" and float(row["metrics"]["precision"]) == pytest.approx(got["precision"])
