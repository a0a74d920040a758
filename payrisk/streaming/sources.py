"""Stream sources and sinks (SRC-1, SRC-2, SNK-2, SNK-4, STR-4).

Production reads Kafka (``format("kafka")``, needs the Kafka connector on the
classpath); tests and the registered queries read a directory of landed
files with the same columns.  Sinks are checkpointed under the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk import schemas as S
from payrisk.functions.columns import iso_to_timestamp, json_number, once

RAW_COLUMNS = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """SRC-1 / SRC-2: Kafka topic as a stream of (topic, partition, offset, key, value).  Offsets lost
    before they were read end the stream, unless ``fail_on_data_loss`` is off."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select("topic", "partition", "offset", "key", "value")


def kafka_snapshot(spark: SparkSession, servers: str, topic: str, starting_ms: int | None = None,
                   ending_ms: int | None = None) -> DataFrame:
    """SRC-3 / SRC-4: a bounded batch read of a topic — from ``starting_ms``
    (epoch ms; earliest when None) to ``ending_ms`` (latest when None) — with
    the Kafka columns; feed it to ``sources.logs.snapshot_payments`` or
    ``snapshot_features``."""
    r = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    r = r.option("startingTimestamp", str(starting_ms)) if starting_ms is not None else r.option(
        "startingOffsets", "earliest")
    r = r.option("endingTimestamp", str(ending_ms)) if ending_ms is not None else r.option("endingOffsets", "latest")
    return r.load().select("topic", "partition", "offset", "key", "value")


def file_message_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Test double of the Kafka source: Parquet files with the Kafka columns."""
    r = spark.readStream.schema(RAW_COLUMNS).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def json_lines_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Directory of JSON-lines text files as a stream of ``value`` strings."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def any_not_null(cols: list[str]) -> Column:
    """True when at least one of ``cols`` is not null."""
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNotNull()
    return out


def decoded(messages: DataFrame, value: str = "value") -> DataFrame:
    """``messages`` and ``p``, the payment event as a struct of its declared types, each number accepted as a number or as text.
    The text is parsed once a row (:func:`once`), not for each field that is used."""
    read = messages.select("*", once(F.from_json(F.col(value).cast("string"), S.PAYMENTS_TEXT).alias("_text")))

    def typed(f: T.StructField) -> Column:
        raw = F.col("_text")[f.name]
        if isinstance(f.dataType, T.DoubleType):
            raw = json_number(raw)
        elif isinstance(f.dataType, T.IntegerType):
            raw = json_number(raw).try_cast("int")
        elif isinstance(f.dataType, T.BooleanType):
            raw = raw.try_cast("boolean")
        return raw.alias(f.name)

    return read.withColumn("p", F.struct(*map(typed, S.PAYMENTS_RAW.fields))).drop("_text")


def decode_payments(messages: DataFrame, value: str = "value") -> DataFrame:
    """PRJ-1 + PRJ-2: JSON → 19 typed columns (a message that does not parse
    at all is skipped), plus ``event_time`` = event_ts parsed as ISO-8601 and
    truncated to the second (UTC TIMESTAMP, as a watermark needs)."""
    p = decoded(messages, value)
    # PERMISSIVE from_json turns an unparseable document into an all-null struct: drop those
    out = p.select("p.*").where(any_not_null(S.PAYMENTS_RAW.fieldNames()))
    et = F.date_trunc("second", iso_to_timestamp(F.col("event_ts")).cast("timestamp"))
    return out.withColumn("event_time", et)


def decode_requests(messages: DataFrame, value: str = "value") -> DataFrame:
    """:func:`decode_payments` that keeps every message: ``raw`` is its text (bad bytes become U+FFFD) and ``decode_error`` says
    why nothing could be read of it (``no_value``, ``invalid_utf8``, ``not_json``, ``not_object``), null if something could."""
    text = F.col(value).cast("string")
    why = (F.when(text.isNull(), "no_value").when(~F.is_valid_utf8(text), "invalid_utf8")
           .when(F.try_parse_json(text).isNull(), "not_json").when(~F.regexp_like(text, F.lit(r"^[ \t\r\n]*\{")), "not_object"))
    read = decoded(messages, value).select("p", F.make_valid_utf8(text).alias("raw"), why.alias("_why"))
    some = any_not_null([f"p.{f}" for f in S.PAYMENTS_RAW.fieldNames()])
    out = read.select("p.*", "raw", F.when(~some, F.col("_why")).alias("decode_error"))
    return out.withColumn("event_time", F.date_trunc("second", iso_to_timestamp(F.col("event_ts")).cast("timestamp")))


def to_json_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """SNK-2 / SNK-4: rows as Kafka records: optional ``key`` column and JSON ``value``."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)
