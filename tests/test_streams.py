"""Streams: stream = batch, late rows, restart idempotence, duplicate drop."""
import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from payrisk.streaming import jobs, online, sources
from payrisk.streaming.features import card_velocity_stream


def _msg(card, ts, amount=1.0):
    return json.dumps({"event_id": f"{card}-{ts.isoformat()}", "card_id": card, "amount": amount,
                       "event_ts": ts.isoformat() + "Z"})


def test_late_rows(spark, tmp_dir):
    """One file per batch: within the watermark → kept; for a closed window one
    batch after the watermark passed → still counted; two batches after → dropped."""
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    t0 = datetime(2024, 1, 1, 0, 0, 10)
    files = [
        [_msg("a", t0)],                                   # window ending 00:01
        [_msg("a", t0 + timedelta(minutes=1, seconds=10))],  # watermark -> 00:01:15
        [_msg("a", t0 + timedelta(seconds=20))],           # late, judged by previous watermark (00:00:05): kept
        [_msg("b", t0 + timedelta(minutes=2))],            # moves watermark on
        [_msg("a", t0 + timedelta(seconds=30))],           # now late for a closed window: dropped
    ]
    for i, lines in enumerate(files):
        p = f"{src}/f{i}.json"
        open(p, "w").write("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = sources.decode_payments(sources.json_lines_source(spark, src, max_files_per_trigger=1))
    q = (card_velocity_stream(stream).writeStream.format("memory").queryName("late_rows")
         .outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", f"{tmp_dir}/ck").start())
    q.awaitTermination()
    rows = {(r["card_id"], r["event_timestamp"].minute): r["txn_count_1m"]
            for r in spark.sql("select * from late_rows").collect()}
    assert rows[("a", 1)] == 2
    dropped = sum(p.get("stateOperators", [{}])[0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress)
    assert dropped >= 1


FEATURES = "card_id string, event_timestamp timestamp_ntz, txn_count_1m long, amount_sum_1m double"


def _push(spark, root, schema=FEATURES):
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
    online.start_online(stream, f"{root}/ck", {"availableNow": True}).awaitTermination()
    return online.read_online(spark, f"{root}/ck")


def _counts(table):
    return {r["card_id"]: r["txn_count_1m"] for r in table.collect()}


def test_online_table_is_the_state(spark, tmp_dir):
    """Older rows that come later change nothing; a run again without input changes nothing; before a batch there is no table."""
    assert online.read_online(spark, f"{tmp_dir}/ck") is None
    spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 1), 1, 1.0), ("b", datetime(2024, 1, 1, 0, 1), 2, 2.0), ("a", datetime(2024, 1, 1, 0, 1), 0, 9.0)],
                          FEATURES).coalesce(1).write.parquet(f"{tmp_dir}/in/p1")
    assert _counts(_push(spark, tmp_dir)) == {"a": 1, "b": 2}
    spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 2), 5, 5.0), ("b", datetime(2024, 1, 1, 0, 0), 9, 9.0)], FEATURES).coalesce(1).write.parquet(f"{tmp_dir}/in/p2")
    table = _push(spark, tmp_dir)
    assert _counts(table) == {"a": 5, "b": 2} == _counts(_push(spark, tmp_dir))
    assert table.columns == ["card_id", "event_timestamp", "created_timestamp", "txn_count_1m", "amount_sum_1m"]
    assert all(r["created_timestamp"] is not None for r in table.collect())


def test_online_batches_cost_their_own_cards(spark, tmp_dir):
    """Sixteen batches: each updates the rows of its own cards only, however many the table holds."""
    for b in range(16):
        rows = [(f"c{i}", datetime(2024, 1, 1, 0, b), b, 1.0) for i in (range(400) if b == 0 else (b, b + 1))]
        spark.createDataFrame(rows, FEATURES).coalesce(1).write.parquet(f"{tmp_dir}/in/p{b:02d}")
        os.utime(f"{tmp_dir}/in/p{b:02d}", (1_700_000_000 + b, 1_700_000_000 + b))
    stream = spark.readStream.schema(FEATURES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in")
    q = online.start_online(stream, f"{tmp_dir}/ck", {"availableNow": True})
    q.awaitTermination()
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"]]
    assert sorted(updated) == [2] * 15 + [400] and q.lastProgress["stateOperators"][0]["numRowsTotal"] == 400
    want = {f"c{i}": 0 for i in range(400)} | {f"c{b}": b for b in range(1, 16)} | {"c16": 15}
    assert _counts(online.read_online(spark, f"{tmp_dir}/ck")) == want


def test_feature_records_of_both_views(spark):
    from payrisk.sources.logs import FEATURE_VIEWS, snapshot_features

    good = {"card_id": "a", "event_timestamp": "2024-01-01T00:05:00Z", "created_timestamp": "2024-01-01T00:05:01Z", "txn_count_5m": "3", "avg_transaction_amount_5m": 1.5}
    df = spark.createDataFrame([(json.dumps(good),), (json.dumps(good | {"txn_count_5m": "x"}),), ("{",)], "value string")
    (r,) = snapshot_features(df, FEATURE_VIEWS["5m"]).collect()
    assert (r["card_id"], r["txn_count_5m"], r["avg_transaction_amount_5m"]) == ("a", 3, 1.5)


def test_stream_equals_batch(spark):
    from payrisk.plans.registry import QUERIES
    from payrisk.operators.velocity import card_velocity_1m
    from payrisk.sources.fixtures import payments

    s = QUERIES["stream_card_velocity_1m"](spark, "/root/testdata/sf0.001")
    pay = payments(spark, "/root/testdata/sf0.001").withColumn(
        "event_timestamp", F.date_trunc("second", "event_timestamp").cast("timestamp_ntz"))
    b = card_velocity_1m(pay).withColumn("amount_sum_1m", F.round("amount_sum_1m", 6))
    wm = pay.agg(F.max("event_timestamp")).first()[0] - timedelta(seconds=5)
    b = b.where(F.col("event_timestamp") <= F.lit(wm))
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_decode_drops_unparseable(spark):
    df = spark.createDataFrame([("not json",), ('{"card_id": "a", "amount": 1.0, "event_ts": "2024-01-01T00:00:00Z"}',),
                                ("[]",)], "value string")
    out = sources.decode_payments(df).collect()
    assert len(out) == 1 and out[0]["card_id"] == "a" and out[0]["event_time"] is not None


def test_model_fallback(spark, tmp_dir):
    from payrisk.plans.train import load_model_or_fallback

    assert load_model_or_fallback(f"{tmp_dir}/missing") == (None, "fallback")
    assert load_model_or_fallback(None) == (None, "fallback")


def test_score_batch_with_model(spark, tmp_dir):
    """STR-6 with a trained model (ML-4) and a rejected request (STR-9)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from payrisk import schemas as S

    train = spark.createDataFrame([(float(i % 3), float(i), float(i % 2), float(i), float(i * 10), i % 2)
                                   for i in range(40)], "txn_count_1m double, amount_sum_1m double, txn_count_5m double, "
                                                        "avg_transaction_amount_5m double, amount double, is_fraud int")
    model = Pipeline(stages=[VectorAssembler(inputCols=S.FEATURE_ORDER, outputCol="features"),
                             LogisticRegression(labelCol="is_fraud", maxIter=5)]).fit(train)
    feats = spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 1), 3, 30.0)],
                                  "card_id string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, "
                                  "txn_count_1m long, amount_sum_1m double")
    feats.write.parquet(f"{tmp_dir}/in")
    _push(spark, tmp_dir, feats.schema)
    batch = spark.createDataFrame([("e1", "a", 12.0, "t", "t"), ("e2", "", 5.0, "t", "t"), ("e3", "z", 7.0, "t", "t")],
                                  "event_id string, card_id string, amount double, event_ts string, ingest_ts string")
    jobs.score_batch(batch, 0, f"{tmp_dir}/ck", None, f"{tmp_dir}/dec", f"{tmp_dir}/log", f"{tmp_dir}/err",
                     model=model, version="7")
    dec = {r["event_id"]: r for r in spark.read.parquet(f"{tmp_dir}/dec/*").collect()}
    assert set(dec) == {"e1", "e3"} and dec["e1"]["model_version"] == "7"
    assert 0.0 <= dec["e1"]["fraud_probability"] <= 1.0
    err = spark.read.parquet(f"{tmp_dir}/err/*").collect()
    assert [(r["event_id"], r["reason"]) for r in err] == [("e2", "card_id_empty")]
    log = spark.read.json(f"{tmp_dir}/log/*").collect()
    miss = {r["event_id"]: r["missing_features"] for r in log}
    assert miss["e3"] == ["txn_count_1m", "amount_sum_1m", "txn_count_5m", "avg_transaction_amount_5m"]
    assert miss["e1"] == ["txn_count_5m", "avg_transaction_amount_5m"]


def test_score_batch_ttl_and_missing_id(spark, tmp_dir):
    feats = spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 1), 3, 30.0)],
                                  "card_id string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, "
                                  "txn_count_1m long, amount_sum_1m double")
    feats.write.parquet(f"{tmp_dir}/in")
    _push(spark, tmp_dir, feats.schema)
    batch = spark.createDataFrame([(None, "a", 1.0, "2024-01-01T01:00:00Z", "2024-01-01T01:00:00Z"),
                                   ("e2", "a", 1.0, "2024-01-01T05:00:00Z", "2024-01-01T05:00:00Z")],
                                  "event_id string, card_id string, amount double, event_ts string, ingest_ts string")
    jobs.score_batch(batch, 0, f"{tmp_dir}/ck", None, f"{tmp_dir}/dec", f"{tmp_dir}/log", f"{tmp_dir}/err",
                     apply_ttl=True)
    log = {r["event_id"]: r for r in spark.read.json(f"{tmp_dir}/log/*").collect()}
    gen = [k for k in log if k != "e2"]
    assert len(gen) == 1 and gen[0].startswith("gen-") and log[gen[0]]["event_id_missing"] is True
    assert log[gen[0]]["txn_count_1m"] == 3          # within 120 min of the feature
    assert log["e2"]["txn_count_1m"] == 0 and "txn_count_1m" in log["e2"]["missing_features"]  # expired
    assert log["e2"]["status"] == "ok" and log["e2"]["latency_ms"] is not None


def test_label_join_emits_unmatched_after_watermark(spark, tmp_dir):
    """JOIN-6: a prediction without a label inside the horizon comes out with
    nulls once both watermarks pass; a matched one comes out with its label."""
    t0 = datetime(2024, 1, 1, 0, 0)
    ps, ls = f"{tmp_dir}/p", f"{tmp_dir}/l"
    pschema, lschema = "event_id string, ts timestamp", "l_event_id string, is_fraud int, label_timestamp timestamp"
    spark.createDataFrame([("a", t0), ("b", t0)], pschema).write.parquet(f"{ps}/1")
    spark.createDataFrame([("a", 1, t0 + timedelta(minutes=30))], lschema).write.parquet(f"{ls}/1")
    # later rows move both watermarks past t0 + 60 min + 10 min
    spark.createDataFrame([("z", t0 + timedelta(hours=3))], pschema).write.parquet(f"{ps}/2")
    spark.createDataFrame([("y", 0, t0 + timedelta(hours=3))], lschema).write.parquet(f"{ls}/2")
    p = spark.readStream.schema(pschema).option("recursiveFileLookup", "true").parquet(ps)
    lab = spark.readStream.schema(lschema).option("recursiveFileLookup", "true").parquet(ls)
    q = (jobs.label_join_stream(p, lab).writeStream.format("memory").queryName("lj").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["event_id"]: r["is_fraud"] for r in spark.sql("select * from lj").collect()}
    assert got.get("a") == 1
    assert "b" in got and got["b"] is None


def test_label_outcomes_have_null_rows(spark):
    """JOIN-6: predictions whose label is missing or late come out with nulls, once each; late labels are in the input."""
    from payrisk.plans import registry
    from payrisk.sources import fixtures

    sf = "/root/testdata/sf0.001"
    rows = registry.QUERIES["stream_label_outcomes"](spark, sf).collect()
    null = [r["event_id"] for r in rows if r["label_timestamp"] is None]
    matched = {r["event_id"] for r in rows} - set(null)
    late = fixtures.labels_log(registry._pay(spark, sf)).where("delay_seconds > 3600").select("event_id").distinct()
    assert null and len(null) == len(set(null)) and matched
    assert {r["event_id"] for r in late.collect()} & set(null)
    assert any(int(i) % 10 == 0 for i in null)  # these never get a label


def _in_order(spark, rows, schema, ts, path):
    """Four files in time order, read one a micro-batch."""
    rows = sorted(rows, key=lambda r: r[ts])
    for k in range(4):
        spark.createDataFrame(rows[k * len(rows) // 4 : (k + 1) * len(rows) // 4], schema).coalesce(1).write.parquet(f"{path}/p{k}")
        for f in os.listdir(f"{path}/p{k}"):
            os.utime(f"{path}/p{k}/{f}", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(path)


def _run_to(df, tmp_dir, name):
    df.writeStream.format("parquet").option("path", f"{tmp_dir}/{name}").option("checkpointLocation", f"{tmp_dir}/{name}-ck").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{tmp_dir}/{name}").collect()


def test_geo_flags_over_batches(spark, tmp_dir):
    """An earlier event in another country, batches ago or of the same second, flags; the own country, or 300 s and more before, does not."""
    import random

    from payrisk.streaming.features import geo_flags_stream

    rng, t0 = random.Random(3), datetime(2024, 1, 1)
    rows = [(f"e{i:03d}", rng.choice("abc"), rng.choice(["US", "GB", None]), t0 + timedelta(seconds=rng.randint(0, 400) * 10)) for i in range(300)]
    schema = "event_id string, card_id string, country string, event_time timestamp"
    now = _in_order(spark, rows, schema, 3, f"{tmp_dir}/in")
    again = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in")
    got = {r["event_id"]: r["geo_change_flag_5m"] for r in _run_to(geo_flags_stream(now, again), tmp_dir, "geo")}
    end = max(r[3] for r in rows) - timedelta(seconds=305)
    want = {i: int(any(d == c and (s, j) < (t, i) and s >= t - timedelta(seconds=300) and o != k for j, d, o, s in rows)) for i, c, k, t in rows if t < end}
    assert got == want and {0, 1} == set(want.values())


def test_enriched_over_batches(spark, tmp_dir):
    """Newest row of each view at the event's time, within its own TTL; ties by created time; events without a row have nulls."""
    import random

    from payrisk.streaming.features import enriched_stream

    rng, t0 = random.Random(4), datetime(2024, 1, 1)
    views = {"v1": (["x"], 600), "v2": (["y"], 1800)}
    events = [(f"e{i:03d}", rng.choice("abcd"), t0 + timedelta(seconds=rng.randint(0, 9000))) for i in range(200)]
    feats = [(c := rng.choice("abc"), t := t0 + timedelta(seconds=300 * rng.randint(0, 40)), t + timedelta(seconds=k), v := rng.choice(["v1", "v2"]), k if v == "v1" else None, k * 2.0 if v == "v2" else None)
             for k in range(150)]
    left = _in_order(spark, events, "event_id string, card_id string, event_timestamp timestamp", 2, f"{tmp_dir}/e")
    right = _in_order(spark, feats, "card_id string, event_timestamp timestamp, created_timestamp timestamp, view string, x long, y double", 1, f"{tmp_dir}/f")
    got = {r["event_id"]: (r["x"], r["y"]) for r in _run_to(enriched_stream(left, right, views), tmp_dir, "out")}

    def newest(card, at, view, ttl):
        rows = [(t, made, x if view == "v1" else y) for c, t, made, v, x, y in feats if (c, v) == (card, view) and at - timedelta(seconds=ttl) <= t <= at]
        return max(rows)[2] if rows else None

    end = min(max(e[2] for e in events), max(f[1] for f in feats)) - timedelta(seconds=1805)
    assert got == {i: (newest(c, t, "v1", 600), newest(c, t, "v2", 1800)) for i, c, t in events if t < end}


def test_decoding_parses_a_message_once(spark):
    """Neither the typed columns nor the filter on them copy the parse."""
    from payrisk.sources import logs
    from payrisk.streaming import sources

    lines = spark.createDataFrame([('{"event_id": "a", "card_id": "c", "amount": "2.5", "event_ts": "2024-01-01T00:00:00Z"}',), ("x",)], "value string")
    for out in (sources.decode_payments(lines), sources.decode_requests(lines), logs.snapshot_payments(lines)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [(r.event_id, r.amount) for r in sources.decode_payments(lines).collect()] == [("a", 2.5)]
