"""Tolerant scans of JSON-lines logs (SRC-8) and bounded topic snapshots (SRC-3, SRC-4).

Logs are read with an all-string schema and ``DROPMALFORMED`` (blank and
broken lines are skipped; a typed schema would drop a whole row for one bad
value, while the reference keeps the row and coerces the value), then typed
with ``try_cast``.  A missing path yields an empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk import schemas as S
from payrisk.functions.columns import default_if_falsy, iso_to_timestamp


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-8: all-string scan of a JSON-lines file/dir; malformed and blank lines
    dropped; missing path → empty frame with the schema."""
    strings = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    if not _exists(spark, path):
        return spark.createDataFrame([], strings)
    return spark.read.schema(strings).option("mode", "DROPMALFORMED").json(path)


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """Prediction log as strings (typed later by the evaluation's normalisation); ``missing_features`` as an array."""
    log = read_jsonl(spark, path, S.PREDICTION_LOG_STRINGS)
    return log.withColumn("missing_features", F.from_json("missing_features", "array<string>"))


def read_labels_log(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, S.LABELS_LOG_STRINGS)


def snapshot_payments(messages: DataFrame) -> DataFrame:
    """SRC-3 + FLT-6 + PRJ-6: a bounded batch of payment messages (e.g.
    ``spark.read.format("kafka")`` with starting/ending timestamps) → the
    ``payments_v1`` table: events without ``event_ts`` skipped, ``amount`` and
    ``is_fraud`` defaulted to 0 when missing, rows without card or time
    dropped."""
    from payrisk.streaming.sources import any_not_null, decoded

    p = decoded(messages).select("p.*").where(any_not_null(S.PAYMENTS_RAW.fieldNames()))
    p = p.where(F.col("event_ts").isNotNull() & (F.col("event_ts") != ""))
    out = p.select(
        "card_id",
        iso_to_timestamp(F.col("event_ts")).alias("event_timestamp"),
        default_if_falsy("amount", 0.0).cast("double").alias("amount"),
        "channel", "country", "city",
        default_if_falsy("is_fraud", 0).cast("int").alias("is_fraud"))
    return out.dropna(subset=["card_id", "event_timestamp"])


#: Columns of the feature records by view, besides card and times.
FEATURE_VIEWS = {"1m": {"txn_count_1m": "long", "amount_sum_1m": "double"},
                 "5m": {"txn_count_5m": "long", "avg_transaction_amount_5m": "double"}}


def snapshot_features(messages: DataFrame, fields: dict[str, str] = FEATURE_VIEWS["1m"]) -> DataFrame:
    """SRC-4: feature records from a topic snapshot (read from earliest), or a topic as a stream: every
    column parsed leniently (``try_cast``), rows with any unparseable or missing value skipped."""
    names = ["card_id", "event_timestamp", "created_timestamp", *fields]
    doc = F.from_json(F.col("value").cast("string"), T.StructType([T.StructField(n, T.StringType()) for n in names]))
    p = messages.select(doc.alias("p")).select("p.*")
    typed = p.select(
        F.col("card_id"),
        iso_to_timestamp(F.col("event_timestamp")).alias("event_timestamp"),
        iso_to_timestamp(F.col("created_timestamp")).alias("created_timestamp"),
        *[F.col(n).try_cast("double").try_cast(kind).alias(n) for n, kind in fields.items()])
    return typed.dropna()
