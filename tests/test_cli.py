"""Command-line jobs end to end on small inputs."""
from pyspark.sql import functions as F

from payrisk.cli import main
from payrisk.sources import fixtures

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _logs(spark, root):
    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    log = fixtures.prediction_log(pay).withColumn("ts", F.date_format("ts", ISO))
    log.select(F.to_json(F.struct("ts", "event_id", "amount", "txn_count_1m", "amount_sum_1m", "fraud_probability")))\
        .write.mode("overwrite").text(f"{root}/preds")
    fixtures.labels_log(pay).withColumn("label_timestamp", F.date_format("label_timestamp", ISO)) \
        .select(F.to_json(F.struct("event_id", "is_fraud", "label_timestamp"))).write.mode("overwrite").text(f"{root}/labels")
    return pay


def test_evaluate_eventid_exit_codes(spark, tmp_dir, capsys):
    _logs(spark, tmp_dir)
    args = ["evaluate-eventid", "--prediction_log_path", f"{tmp_dir}/preds", "--labels_log_path", f"{tmp_dir}/labels"]
    assert main(args + ["--allow_partial", "1"]) == 0
    assert main(args) == 1  # unlabeled predictions and strict mode
    assert main(args + ["--allow_partial", "1", "--min_join_rate", "0.99"]) == 1
    assert "join_rate" in capsys.readouterr().out


def test_features_drift_and_ingest(spark, tmp_dir):
    pay = _logs(spark, tmp_dir)
    pay.write.parquet(f"{tmp_dir}/payments")
    assert main(["features", "--payments_path", f"{tmp_dir}/payments", "--out_1m", f"{tmp_dir}/f1",
                 "--out_5m", f"{tmp_dir}/f5"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/f1").count() > 0
    assert main(["drift", "--payments_path", f"{tmp_dir}/payments", "--offline_features_path", f"{tmp_dir}/f1",
                 "--prediction_log_path", f"{tmp_dir}/preds"]) == 0
    csv = fixtures.creditcard_csv(spark, "/root/testdata/sf0.001", f"{tmp_dir}/csv")
    rc = main(["ingest", "--input_csv", csv, "--output_parquet", f"{tmp_dir}/real",
               "--output_report_json", f"{tmp_dir}/report"])
    assert rc == 0 and spark.read.parquet(f"{tmp_dir}/real").count() > 0
    assert spark.read.json(f"{tmp_dir}/report").first()["rows"] > 0


def test_update_features_and_one_card_of_the_online_table(spark, tmp_dir, capsys):
    fixtures.payments(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/payments")
    assert main(["update-features", "--payments_path", f"{tmp_dir}/payments", "--output_path", f"{tmp_dir}/views", "--checkpoint", f"{tmp_dir}/ckpt"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/views/5m").count() > 0
    one = spark.read.parquet(f"{tmp_dir}/views/1m").drop("batch")
    one.write.parquet(f"{tmp_dir}/f1")
    assert main(["publish-online", "--table_path", f"{tmp_dir}/online", "--published_path", f"{tmp_dir}/pub"]) == 1  # nothing yet
    assert main(["push-online", "--input_path", f"{tmp_dir}/f1", "--table_path", f"{tmp_dir}/online", "--once", "1"]) == 0
    assert main(["publish-online", "--table_path", f"{tmp_dir}/online", "--published_path", f"{tmp_dir}/pub", "--buckets", "4"]) == 0
    capsys.readouterr()
    card = one.first()["card_id"]
    assert main(["online-read", "--published_path", f"{tmp_dir}/pub", "--card_id", card]) == 0
    assert f'"card_id":"{card}"' in capsys.readouterr().out
