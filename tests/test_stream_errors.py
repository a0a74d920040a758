"""Messages that can't be read or scored stay, with their text and the reason; dead-letter records as JSON."""
import glob
import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from payrisk.streaming import jobs
from payrisk.streaming.sources import RAW_COLUMNS, decode_payments, decode_requests

GOOD = {"event_id": "1", "card_id": "c", "amount": 5.0, "event_ts": "2024-01-01T00:00:00Z", "ingest_ts": "2024-01-01T00:00:00Z"}
VALUES = [json.dumps(GOOD).encode(), json.dumps({**GOOD, "event_id": "2", "amount": "7.5"}).encode(), b"not json", b"[1]", b"", None,
          b"\xff" + json.dumps(GOOD).encode(), json.dumps({**GOOD, "amount": -1}).encode(), json.dumps({**GOOD, "card_id": ""}).encode(), b"{}",
          b"x" * 100_000]


# 150,000 messages of 3 KB in two partitions, scored in a JVM of 512 MB: their text is many times what it can hold.
LARGE = """
import sys
from pyspark.sql import SparkSession, functions as F
from payrisk.streaming import jobs
from payrisk.streaming.sources import decode_requests
out = sys.argv[1]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", f"{out}/ckpt").getOrCreate())
ts = F.lit("2024-01-01T00:00:00Z")
text = F.to_json(F.struct(F.when(F.col("id") % 50 != 1, F.col("id").cast("string")).alias("event_id"), F.lit("c").alias("card_id"),
                          F.when(F.col("id") % 100 == 0, -1.0).otherwise(5.0).alias("amount"), ts.alias("event_ts"), ts.alias("ingest_ts"),
                          F.repeat(F.lit("x"), F.lit(3000)).alias("note")))
batch = decode_requests(spark.range(0, 150_000, 1, 2).select(text.cast("binary").alias("value")))
jobs.score_batch(batch, 0, None, None, f"{out}/d", f"{out}/l", f"{out}/e")
scored, errors = spark.read.parquet(f"{out}/d/*"), spark.read.parquet(f"{out}/e/*")
print("GOT", scored.count(), scored.select("event_id").distinct().count(), errors.count(), errors.agg(F.min(F.length("raw"))).first()[0] > 3000,
      spark.read.json(f"{out}/l/*").count())
"""


def _messages(spark, values):
    return spark.createDataFrame([("t", 0, i, None, v) for i, v in enumerate(values)], RAW_COLUMNS)


def test_every_message_is_scored_or_kept(spark, tmp_dir):
    batch = decode_requests(_messages(spark, VALUES))
    for _ in range(2):  # a batch that is run again leaves the same rows
        jobs.score_batch(batch, 0, None, None, f"{tmp_dir}/d", f"{tmp_dir}/l", f"{tmp_dir}/e")
    scored = spark.read.parquet(f"{tmp_dir}/d/*")
    assert sorted(r["amount"] for r in scored.collect()) == [5.0, 7.5] and "raw" not in scored.columns
    got = sorted(((r["reason"], (r["raw"] or "")[:6]) for r in spark.read.parquet(f"{tmp_dir}/e/*").collect()))
    assert got == [("amount_invalid", '{"even'), ("card_id_empty", '{"even'), ("card_id_empty", "{}"), ("invalid_utf8", '\ufffd{"eve'), ("no_value", ""),
                   ("not_json", ""), ("not_json", "not js"), ("not_json", "xxxxxx"), ("not_object", "[1]")]
    assert max(len(r["raw"] or "") for r in spark.read.parquet(f"{tmp_dir}/e/*").collect()) == 100_000
    assert spark.read.json(f"{tmp_dir}/l/*").where("status = 'error'").count() == 9


def test_a_batch_larger_than_memory_is_scored_whole(tmp_dir):
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", LARGE, tmp_dir], env=env, cwd=tmp_dir, capture_output=True, text=True, timeout=300)
    got = [x for x in run.stdout.splitlines() if x.startswith("GOT")]
    assert got == ["GOT 148500 148500 1500 True 150000"], run.stderr[-2000:]
    assert not glob.glob(f"{tmp_dir}/ckpt/*/payrisk/*")  # what the batch landed for itself is gone


def test_payments_decoded_without_reasons_still_score(spark, tmp_dir):
    jobs.score_batch(decode_payments(_messages(spark, VALUES)), 0, None, None, f"{tmp_dir}/d", f"{tmp_dir}/l", f"{tmp_dir}/e")
    errors = spark.read.parquet(f"{tmp_dir}/e/*")
    assert spark.read.parquet(f"{tmp_dir}/d/*").count() == 2 and errors.where("raw is null").count() == errors.count() == 2


def test_dead_letter_records(spark):
    rows = [("not_json", "x�", "t", 3, 7), ("not_object", "[]", None, None, None)]
    got = [json.loads(r["value"]) for r in jobs.dlq_records(spark.createDataFrame(rows, "error string, raw string, topic string, partition int, offset long")
                                                            .withColumn("more", F.lit(1))).collect()]
    assert got == [{"error": "not_json", "raw": "x�", "topic": "t", "partition": 3, "offset": 7}, {"error": "not_object", "raw": "[]"}]
    assert jobs.dlq_records(spark.createDataFrame([], "error string, raw string, topic string, partition int, offset long")).count() == 0
