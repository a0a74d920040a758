"""Online latest-per-card table held by Spark's own state (SNK-6, STR-7, WIN-3, PRJ-17, SNK-9).

A feature stream is aggregated per card in update mode; the newest row per card is the state of that aggregate, kept by the state
store under the query's checkpoint: a micro-batch costs what its cards cost, a batch that is run again rewrites its own version, and
Spark keeps, compacts and cleans the versions.  Readers take the newest committed version through the state data source.  Rows that
changed go to the sink, which is nothing by default, or a topic as records keyed by card.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.sources.bucketed import read_buckets, write_buckets
from payrisk.streaming.sources import to_json_value


def latest_stream(features: DataFrame, key: str = "card_id", ts: str = "event_timestamp", created: str = "created_timestamp") -> DataFrame:
    """Newest row per card of a feature stream: newest event time, then newest created time, then the greatest values.
    Rows without a created time get the processing time (PRJ-17)."""
    if created not in features.columns:
        features = features.withColumn(created, F.current_timestamp())
    rest = [c for c in features.columns if c not in (key, ts, created)]
    return features.groupBy(key).agg(F.max(F.struct(ts, created, *rest)).alias("row"))


def start_online(features: DataFrame, checkpoint: str, trigger: dict | None = None, topic: dict | None = None, **names):
    """STR-7: keeps the online table as the state of a checkpointed stream, whose rows come in as often as the source and
    ``trigger`` say (once a second by default).  ``topic``: options of a Kafka sink for the changed rows."""
    latest = latest_stream(features, **names)
    changed = latest.select(names.get("key", "card_id"), "row.*")
    w = to_json_value(changed, key=names.get("key", "card_id")).writeStream.format("kafka").options(**topic) if topic else changed.writeStream.format("noop")
    return (w.option("checkpointLocation", checkpoint).outputMode("update")
             .trigger(**(trigger or {"processingTime": S.ONLINE_PUSH_INTERVAL})).start())


def committed(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the stream of that checkpoint has finished a batch."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path) and any(s.getPath().getName().isdigit() for s in fs.listStatus(path))


def read_online(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """The latest-per-card table as of the last committed batch; None before the first."""
    if not committed(spark, checkpoint):
        return None
    state = spark.read.format("statestore").load(checkpoint)
    row = state.schema["value"].dataType.fieldNames()[0]
    return state.select("key.*", F.col("value")[row].alias("row")).select(*state.schema["key"].dataType.fieldNames(), "row.*")


def publish_online(spark: SparkSession, checkpoint: str, path: str, buckets: int = S.ONLINE_BUCKETS, key: str = "card_id") -> DataFrame | None:
    """The online table as of the last committed batch, written to ``path`` (new) in ``buckets`` files hashed and sorted by card;
    None before the first batch."""
    latest = read_online(spark, checkpoint)
    return None if latest is None else write_buckets(latest, path, [key], buckets)


def read_card(spark: SparkSession, path: str, card_id: str, key: str = "card_id") -> DataFrame:
    """SNK-9: one card's row of a published online table; reads that card's bucket alone."""
    return read_buckets(spark, path, [key]).where(F.col(key) == F.lit(card_id))
