"""JSON validation (FIXTURES §3 JSON cases), DLQ routing, CSV ingestion, UUIDv5, index."""
import json
import uuid

from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.operators.validate import split_valid, validate_messages

GOOD = {
    "event_id": "e1", "card_id": "c1", "user_id": "u1", "merchant_id": "m1", "device_id": "d1", "ip": "1.2.3.4",
    "account_id": "a1", "amount": 12.5, "currency": "USD", "mcc": "5411", "channel": "pos", "is_card_present": True,
    "country": "US", "city": "NYC", "lat": 1.0, "lon": 2.0, "event_ts": "2024-01-01T00:00:00.123456Z",
    "ingest_ts": "2024-01-01T00:00:01Z", "is_fraud": 0,
}


def _with(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is _DROP:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d).encode()


_DROP = object()

CASES = [
    (_with(), None),
    (_with(amount="1"), "type:amount"),
    (_with(is_fraud=1.0), None),
    (_with(is_fraud=2), "enum:is_fraud"),
    (_with(is_fraud=True), "type:is_fraud"),
    (_with(channel="atm"), "enum:channel"),
    (_with(amount=None), "type:amount"),
    (_with(amount=_DROP), "missing_required:amount"),
    (b"[]", "not_object"),
    (b"not json", "not_json"),
    (b"\xff" + _with(), "invalid_utf8"),
    (_with(extra=1), None),
    (_with(lat=5), None),
    (_with(is_fraud=1.5), "type:is_fraud"),
    (_with()[:-1] + b', "amount": 3}', "not_json"),   # duplicate key
    (_with().replace(b'"amount": 12.5', b'"amount": NaN'), "not_json"),
]


def test_json_cases(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "offset long, value binary")
    got = {r["offset"]: r["error"] for r in validate_messages(df).collect()}
    assert got == {i: e for i, (_, e) in enumerate(CASES)}


def test_routing_counts_and_repair(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "offset long, value binary")
    valid, dlq = split_valid(df)
    assert valid.count() + dlq.count() == len(CASES)
    assert valid.where(F.col("is_fraud").isNull()).count() == 0
    raw = dlq.where(F.col("error") == "invalid_utf8").first()["raw"]
    assert raw.startswith("�") and '"card_id"' in raw


def test_uuid5_matches_python(spark):
    from payrisk.functions.columns import uuid5_expr

    df = spark.range(50).select(uuid5_expr(F.concat(F.lit("creditcard:"), F.col("id").cast("string"))).alias("u"), "id")
    ns = uuid.UUID(S.INGEST_UUID_NAMESPACE)
    for r in df.collect():
        assert r["u"] == str(uuid.uuid5(ns, f"creditcard:{r['id']}"))


def test_index_after_drops(spark, tmp_dir):
    from payrisk.plans.ingest import ingest_csv

    lines = ["Time,V1,Amount,Class", "0,a,1.0,0", "1,b,2.0,1", "2,c,,0", "3,d,-1,0", "4,e,5.0,x", "5,f,6.0,0"]
    p = f"{tmp_dir}/cc.csv"
    open(p, "w").write("\n".join(lines) + "\n")
    pay, rep = ingest_csv(spark, p, n_cards=3, n_merchants=2)
    rows = pay.orderBy("idx").collect()
    assert [r["idx"] for r in rows] == [0, 1, 2, 3]
    assert [r["amount"] for r in rows] == [1.0, 2.0, 5.0, 6.0]
    assert [r["is_fraud"] for r in rows] == [0, 1, 0, 0]
    assert [r["card_id"] for r in rows] == ["card_0", "card_1", "card_2", "card_0"]
    r = rep.first()
    assert r["rows"] == 4 and r["validation_errors"] == [] and r["fraud_rate"] == 0.25


def test_index_multi_file(spark, tmp_dir):
    from payrisk.operators.index import contiguous_index, with_file_position

    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    df.orderBy("id").repartition(5, "id").sortWithinPartitions("id")
    df.repartitionByRange(6, "id").write.mode("overwrite").option("header", True).csv(f"{tmp_dir}/m")
    scan = spark.read.option("header", True).option("maxPartitionBytes", "4096").csv(f"{tmp_dir}/m")
    x = with_file_position(scan, ["id", "k"]).where(F.col("k") != "3")
    got = contiguous_index(x).select(F.col("id").cast("long"), "idx").orderBy("id").collect()
    assert [r["idx"] for r in got] == list(range(len(got)))


def test_quality_rules_p999_and_labels(spark):
    from datetime import datetime

    from payrisk.operators.quality import quality_errors

    rows = [("c", "m", datetime(2024, 1, 1), float(a), y) for a, y in
            [(1.0, 0)] * 990 + [(12345678.9, 1)] * 10 + [(-1.0, 2)]]
    df = spark.createDataFrame(rows, "card_id string, merchant_id string, event_timestamp timestamp_ntz, "
                                     "amount double, is_fraud int")
    errs = quality_errors(df).first()["validation_errors"]
    assert errs[0] == "amount_has_negative_values"
    assert errs[1] == "amount_p999_too_high p999=12345678.9"
    assert errs[2] == "is_fraud_has_invalid_values count=1"
    assert errs[3] == "event_timestamp_not_utc"


def test_routing_parses_a_message_once(spark):
    """A filter on the outcome must not copy the parse for each use of a field."""
    from payrisk.plans.registry import QUERIES

    for name in ("valid_payments", "dlq_records"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1, name


def test_landed_messages_are_spread(spark, tmp_path):
    from payrisk.sources import fixtures

    landed = fixtures.landed_messages(spark, "/root/testdata/sf0.01", str(tmp_path / "raw"))
    assert len(landed.inputFiles()) >= spark.sparkContext.defaultParallelism
    assert landed.count() == 10_000
