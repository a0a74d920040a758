"""Point-in-time join over stored features (JOIN-1, JOIN-2): the feature side is shuffled once, when it is stored.

A view is stored as one row per (key, time bucket) with the feature rows that an entity row of that bucket may need, in time
order: those of the bucket itself and those that come less than a TTL before it.  There is one feature row per key and window,
so a row's length is bounded by (bucket + TTL) / window.  The table is bucketed by (key, time bucket): a join shuffles the
entity rows only, once for all views with the same number of buckets, and a key that holds a third of all rows is spread
over its time buckets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.functions.columns import epoch_seconds
from payrisk.operators.pit import FeatureView, latest_per_key
from payrisk.sources.bucketed import read_buckets, write_buckets

BUCKET_SECONDS = 3600
BUCKETS = 64
#: Feature entries that a bucket holds, about: one task sorts them.
BUCKET_ENTRIES = 1_000_000


@dataclass(frozen=True)
class StoredView:
    """Where a view is stored, its fields and its time-to-live."""

    path: str
    fields: tuple[str, ...]
    ttl_seconds: int
    key: str = "card_id"
    bucket_seconds: int = BUCKET_SECONDS

    @property
    def folder(self) -> str:
        return f"{self.path.rstrip('/')}/every-{self.bucket_seconds}"

    def rows(self, spark: SparkSession) -> DataFrame:
        return read_buckets(spark, self.folder, [self.key, "_bucket"])


def buckets_for(rows: int, views: list[FeatureView], least: int = 8, bucket_seconds: int = BUCKET_SECONDS) -> int:
    """One number of buckets for ``views`` of at most ``rows`` feature rows each, so a bucket stays the same size as they grow."""
    copies = max(v.ttl_seconds / bucket_seconds + 1 for v in views)
    return max(least, math.ceil(rows * copies / BUCKET_ENTRIES))


def store_view(view: FeatureView, path: str, buckets: int = BUCKETS, bucket_seconds: int = BUCKET_SECONDS) -> StoredView:
    """Stores ``view`` at ``path`` (new).  Of feature rows with one key and time the one created last stays; rows without key
    or time match nothing and are left out.  Take ``buckets`` by size, some 256 MB a bucket."""
    key, = view.keys
    stored = StoredView(path, tuple(view.fields), view.ttl_seconds, key, bucket_seconds)
    ts = F.col(view.ts_col).cast("timestamp_ntz")
    rows = view.df.where(F.col(key).isNotNull() & F.col(view.ts_col).isNotNull()).withColumn(view.ts_col, ts)
    if view.created_col in rows.columns:
        rows = latest_per_key(rows, (key, view.ts_col), view.created_col, None, list(view.fields))
    sec = epoch_seconds(view.ts_col)
    own, reach = F.floor(sec / bucket_seconds), F.floor((sec + view.ttl_seconds) / bucket_seconds)
    entry = F.struct(F.col(view.ts_col).alias("_fts"), *view.fields)
    spread = rows.select(key, entry.alias("f"), F.explode(F.sequence(own, reach)).alias("_bucket")).repartition(buckets, key, "_bucket")
    write_buckets(spread.groupBy(key, "_bucket").agg(F.array_sort(F.collect_list("f")).alias("feats")),
                  stored.folder, [key, "_bucket"], buckets)
    return stored


def join_stored(entities: DataFrame, views: list[StoredView], entity_ts: str = "event_timestamp", fill: dict | None = None) -> DataFrame:
    """As :func:`payrisk.operators.pit.point_in_time_join` over stored views: every entity row, then each view's fields of the
    newest feature row at or before the row's time and within the TTL, else null or ``fill``."""
    spark, names = entities.sparkSession, entities.columns
    out, kept = entities, list(names)
    ts = F.col(entity_ts).cast("timestamp_ntz")
    for width, key in {(v.bucket_seconds, v.key) for v in views}:
        # rows without a key match nothing; a hash of the row spreads them
        bucket = F.when(F.col(key).isNull(), F.xxhash64(*names)).otherwise(F.floor(epoch_seconds(ts) / width))
        out = out.withColumn(f"_bucket_{key}_{width}", bucket)
    for v in views:
        clash = set(v.fields) & set(kept)
        if clash:
            raise ValueError(f"feature columns clash with entity columns: {sorted(clash)}")
        kept += v.fields
        bucket = f"_bucket_{v.key}_{v.bucket_seconds}"
        right = v.rows(spark).select(F.col(v.key), F.col("_bucket").alias(bucket), F.col("feats").alias("_feats"))
        seen = F.filter("_feats", lambda f: f["_fts"] <= ts)
        out = out.join(right, [v.key, bucket], "left").withColumn("_f", F.get(seen, F.size(seen) - 1))
        fresh = F.col("_f._fts") >= F.timestamp_add("SECOND", F.lit(-int(v.ttl_seconds)), ts)
        for f in v.fields:
            got = F.when(fresh, F.col(f"_f.{f}"))
            out = out.withColumn(f, F.coalesce(got, F.lit(fill[f])) if fill and f in fill else got)
        out = out.drop("_feats", "_f")
    return out.select(*kept)
