"""Stand-in inputs built from the driver tables.

The reference reads payment events, prediction logs and label logs that are
not part of the test data.  These builders map the driver tables to rows of
the schemas the jobs expect and do none of the jobs' work: the mapping is a
plain per-row projection (or, for ``payments_large``, the lineitem ⨝ orders
join that defines a payment).  The jobs themselves never rely on how the
rows were made.

Mappings (see SURVEY §7.3):

* ``payments``  ← ``events``: event_id = string(event_id); card_id = 'card_' ‖
  user_id; merchant_id = 'm_' ‖ (event_id % 50); event_timestamp = ts;
  amount = value; channel = 'pos' for purchase/signup else 'ecom'; geography
  from the fixed pool by event_id % 6; is_fraud = (event_type = 'error').
* ``payments_large`` ← ``lineitem`` ⨝ ``orders``: card = customer, merchant =
  supplier, amount = extended price, time = order date + a per-line offset in
  the day; is_fraud = (return flag 'R').
* ``labels_log`` ← ``payments``: label time = event time + 30 to 90 minutes
  for 9 in 10 events (the rest stay unlabeled); events with id % 25 = 0 get a
  second label an hour later with the opposite class (a re-label).
* ``raw_payment_messages`` ← ``payments``: JSON text of the 19-field event;
  when id % 97 = k (k < 12) the message is changed in a known way (most
  changes break a rule; a whole ``1.0`` label and an extra field do not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.session import spread
from payrisk.sources.tables import table


def _pool(idx: Column, pos: int) -> Column:
    return F.element_at(F.array(*[F.lit(g[pos]) for g in S.GEO_POOL]), (idx + 1).cast("int"))


def payments_from_events(events: DataFrame) -> DataFrame:
    """Payments view (schema ``payments_real``, NTZ event time) from ``events``."""
    eid = F.col("event_id")
    g = F.pmod(eid, F.lit(len(S.GEO_POOL)))
    return events.select(
        eid.cast("string").alias("event_id"),
        F.concat(F.lit("card_"), F.col("user_id").cast("string")).alias("card_id"),
        F.concat(F.lit("m_"), F.pmod(eid, F.lit(50)).cast("string")).alias("merchant_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("pos")).otherwise(F.lit("ecom")).alias("channel"),
        _pool(g, 0).alias("country"), _pool(g, 1).alias("city"),
        _pool(g, 2).alias("lat"), _pool(g, 3).alias("lon"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_from_events(table(spark, sf_dir, "events"))


def payments_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments view from ``lineitem`` ⨝ ``orders`` (6x the rows of ``events``)."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
                                           "l_returnflag", "l_linestatus"])
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    g = F.pmod(F.col("l_orderkey"), F.lit(len(S.GEO_POOL)))
    offset = F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 61, F.lit(86400))
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("event_id"),
        F.concat(F.lit("card_"), F.col("o_custkey").cast("string")).alias("card_id"),
        F.concat(F.lit("m_"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        F.timestamp_add("SECOND", offset, F.col("o_orderdate")).alias("event_timestamp"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_linestatus") == "O", F.lit("pos")).otherwise(F.lit("ecom")).alias("channel"),
        _pool(g, 0).alias("country"), _pool(g, 1).alias("city"),
        _pool(g, 2).alias("lat"), _pool(g, 3).alias("lon"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_fraud"),
    )


def labels_log(pay: DataFrame) -> DataFrame:
    """Late labels (schema ``labels_log`` with a TIMESTAMP_NTZ label time).

    Label delay = 1800 + (id·37 mod 3600) seconds (30 to 90 minutes); ids with
    id mod 10 = 0 get no label; ids with id mod 25 = 0 get a second label one
    hour after the first, with the opposite class (a re-label)."""
    eid = F.col("event_id").cast("long")
    delay = F.lit(1800) + F.pmod(eid * 37, F.lit(3600))
    first = (pay.where(F.pmod(eid, F.lit(10)) != 0)
                .select("event_id", F.col("is_fraud"),
                        F.timestamp_add("SECOND", delay, F.col("event_timestamp")).alias("label_timestamp"),
                        delay.cast("double").alias("delay_seconds")))
    relabel = (pay.where(F.pmod(eid, F.lit(25)) == 0)
                  .select("event_id", (F.lit(1) - F.col("is_fraud")).alias("is_fraud"),
                          F.timestamp_add("SECOND", delay + 3600, F.col("event_timestamp")).alias("label_timestamp"),
                          (delay + 3600).cast("double").alias("delay_seconds")))
    return first.unionByName(relabel)


# Broken-message kinds injected into the raw stream, by id % 97.
RAW_FAULTS = {
    0: "amount_as_string", 1: "fraud_as_float", 2: "fraud_out_of_enum", 3: "fraud_as_bool",
    4: "channel_out_of_enum", 5: "amount_null", 6: "amount_absent", 7: "json_array",
    8: "not_json", 9: "invalid_utf8", 10: "extra_field", 11: "card_present_as_string",
}


def payment_fields(pay: DataFrame) -> dict:
    """The 19 wire fields of a payment event as columns of ``pay``."""
    ts_iso = F.date_format(F.col("event_timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return {
        "event_id": F.col("event_id"), "card_id": F.col("card_id"),
        "user_id": F.regexp_replace("card_id", "^card_", "u_"), "merchant_id": F.col("merchant_id"),
        "device_id": F.concat(F.lit("d_"), F.col("card_id")), "ip": F.lit("10.0.0.1"),
        "account_id": F.concat(F.lit("a_"), F.col("card_id")), "amount": F.col("amount"),
        "currency": F.lit("USD"), "mcc": F.lit("5411"), "channel": F.col("channel"),
        "is_card_present": F.col("channel") == "pos", "country": F.col("country"), "city": F.col("city"),
        "lat": F.col("lat"), "lon": F.col("lon"), "event_ts": ts_iso, "ingest_ts": ts_iso,
        "is_fraud": F.col("is_fraud"),
    }


def payment_json_lines(pay: DataFrame) -> DataFrame:
    """Valid JSON documents of all payments, one ``value`` string per row."""
    return pay.select(F.to_json(F.struct(*[c.alias(n) for n, c in payment_fields(pay).items()])).alias("value"))


def raw_payment_messages(pay: DataFrame, topic: str = "payments.v1", partitions: int = 12) -> DataFrame:
    """Kafka-shaped frame (topic, partition, offset, key, value binary) of JSON
    payment events, with the faults of ``RAW_FAULTS`` injected (as edits of the
    valid document)."""
    eid = F.col("event_id").cast("long")
    fields = payment_fields(pay)
    k = F.pmod(eid, F.lit(97))
    good = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    edit = lambda pat, rep: F.regexp_replace(good, F.lit(pat), F.lit(rep))
    text = (F.when(k == 0, edit('"amount":([^,}]+)', '"amount":"$1"'))
             .when(k == 1, edit('"is_fraud":([01])', '"is_fraud":$1.0'))
             .when(k == 2, edit('"is_fraud":[01]', '"is_fraud":2'))
             .when(k == 3, edit('"is_fraud":[01]', '"is_fraud":true'))
             .when(k == 4, edit('"channel":"[a-z]*"', '"channel":"atm"'))
             .when(k == 5, edit('"amount":[^,}]+', '"amount":null'))
             .when(k == 6, edit('"amount":[^,}]+,', ''))
             .when(k == 7, F.lit("[]"))
             .when(k == 8, F.concat(F.lit("not json "), F.col("event_id")))
             .when(k == 10, edit('}$', ',"extra_note":"ok"}'))
             .when(k == 11, edit('"is_card_present":(true|false)', '"is_card_present":"yes"'))
             .otherwise(good))
    value = F.when(k == 9, F.concat(F.unhex(F.lit("FF")), F.encode(good, "UTF-8"))).otherwise(F.encode(text, "UTF-8"))
    return pay.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("card_id"), F.lit(partitions)).cast("int").alias("partition"),
        eid.alias("offset"),
        F.encode(F.col("card_id"), "UTF-8").alias("key"),
        value.alias("value"),
    )


def prediction_log(pay: DataFrame) -> DataFrame:
    """Scored-event log (schema ``prediction_log``, NTZ ``ts``) from payments.

    The scoring itself is the library's (``payrisk.plans.score.score_payments``:
    point-in-time features at event time, flags, fallback model).  Only the
    log's service fields are made up here: ``ts`` = event time, latency
    (id·7919 mod 4000)/10 ms, and status ``error`` for ids with id·31 mod 50 = 0
    (an error record carries no probability or decision).
    """
    from payrisk.plans.score import score_payments

    scored = score_payments(pay)
    eid = F.col("event_id").cast("long")
    err = F.pmod(eid * 31, F.lit(50)) == 0
    return scored.select(
        F.col("event_timestamp").alias("ts"), "event_id", "card_id", "amount",
        F.col("event_timestamp").alias("event_ts"), F.col("event_timestamp").alias("ingest_ts"),
        "txn_count_1m", "amount_sum_1m", "txn_count_5m", "avg_transaction_amount_5m",
        F.when(~err, F.col("fraud_probability")).alias("fraud_probability"),
        F.when(~err, F.col("decision")).alias("decision"),
        "model_version",
        (F.pmod(eid * 7919, F.lit(4000)) / F.lit(10.0)).alias("latency_ms"),
        "missing_features",
        F.lit(False).alias("event_id_missing"),
        F.when(err, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
    )


def document_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Second prediction/label pair: documents scored by length, labelled by
    ``labels.quality`` (only some documents are labelled, so joins are partial).

    prediction ts = 2024-01-01 + doc_id seconds; label time = ts + 1 h.
    """
    docs = table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    lab = table(spark, sf_dir, "labels", ["doc_id", "quality"])
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    preds = docs.select(
        F.col("doc_id").cast("string").alias("event_id"),
        F.timestamp_add("SECOND", F.col("doc_id"), base).alias("ts"),
        F.least(F.col("n_chars") / F.lit(20000.0), F.lit(1.0)).alias("fraud_probability"))
    labels = lab.select(
        F.col("doc_id").cast("string").alias("event_id"), F.col("quality").alias("is_fraud"),
        F.timestamp_add("SECOND", F.col("doc_id") + 3600, base).alias("label_timestamp"))
    return preds, labels


def creditcard_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write a header CSV shaped like the card-transactions file from ``events``
    (Time = seconds since the first event, V1 = user id, Amount = value,
    Class = error flag), in event-id order.  Known defects for the ingest
    rules: ids with id % 101 = 0 have an empty Amount, id % 103 = 0 a negative
    one, id % 107 = 0 a non-numeric Class.  Returns ``path``."""
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "event_type"])
    t0 = ev.agg(F.min("ts")).scalar()
    eid = F.col("event_id")
    secs = F.timestamp_diff("MICROSECOND", t0, F.col("ts")).cast("double") / F.lit(1e6)
    amount = (F.when(F.pmod(eid, F.lit(101)) == 0, F.lit(None).cast("double"))
               .when(F.pmod(eid, F.lit(103)) == 0, -F.col("value")).otherwise(F.col("value")))
    cls = (F.when(F.pmod(eid, F.lit(107)) == 0, F.lit("x"))
            .otherwise((F.col("event_type") == "error").cast("int").cast("string")))
    out = (ev.orderBy("event_id")
             .select(secs.cast("string").alias("Time"), F.col("user_id").cast("string").alias("V1"),
                     amount.cast("string").alias("Amount"), cls.alias("Class")))
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


TOPIC_PARTITIONS = 12


def landed_messages(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Raw messages landed as a Parquet table (what a topic snapshot looks like),
    one file per task, two tasks a core, read back, so the validator's plan starts at a
    scan of bytes."""
    raw_payment_messages(spread(payments(spark, sf_dir)), partitions=TOPIC_PARTITIONS).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def land_json_lines(df: DataFrame, path: str) -> str:
    """Write a ``value`` text column as JSON-lines files, one per task."""
    df.write.mode("overwrite").text(path)
    return path


def with_outage(log: DataFrame, since: str = "2024-01-15 00:00:00", days: int = 5) -> DataFrame:
    """The log with nothing for ``days`` days from ``since`` on: later rows come that much later."""
    later = (F.col("ts") + F.make_dt_interval(days=F.lit(days))).cast(log.schema["ts"].dataType)
    return log.withColumn("ts", F.when(F.col("ts") >= F.lit(since).cast(log.schema["ts"].dataType), later).otherwise(F.col("ts")))
