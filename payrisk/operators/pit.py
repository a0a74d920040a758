"""Point-in-time (as-of) joins with TTL, latest-per-key tables and online lookup.

JOIN-1 / JOIN-2: for every entity row, and for every feature view, take the
newest feature row of the same key with ``ts_feat <= ts_entity`` (ties on
``ts_feat`` go to the newest ``created_timestamp``); drop it when it is older
than ``ts_entity - ttl``.  Entity rows are all kept (duplicates included, null
keys included); unmatched features are null.

Plan (one shuffle; no row blow-up, no range join):

* entity rows and feature rows are tagged and ``unionByName``-ed;
* a running ``last(struct, ignorenulls)`` per view over
  ``Window.partitionBy(keys, time_bucket).orderBy(ts, kind, created)`` carries
  the newest feature row forward to each entity row;
* the window is partitioned by a time bucket as well as the key, so one hot key
  is spread over many tasks.  Each feature row is also replayed ("carry-in")
  into every later bucket that starts within its TTL, in the same projection
  (``explode(sequence(bucket, reach))``), which makes the bucketed result equal
  to the unbucketed one.  With the bucket at least as wide as the TTL (default
  6 h vs 2 h / 4 h) a row is replayed at most once, and only rows within
  one TTL of a bucket end are (≈ TTL / bucket of them).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.functions.columns import epoch_seconds

DEFAULT_BUCKET_SECONDS = 6 * 3600


@dataclass(frozen=True)
class FeatureView:
    """A keyed, timestamped feature table with a time-to-live."""

    name: str
    df: DataFrame
    fields: tuple[str, ...]
    ttl_seconds: int
    keys: tuple[str, ...] = ("card_id",)
    ts_col: str = "event_timestamp"
    created_col: str | None = "created_timestamp"
    extra: dict = field(default_factory=dict)


def _ntz(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def point_in_time_join(entities: DataFrame, views: list[FeatureView], entity_ts: str = "event_timestamp",
                       keys: tuple[str, ...] | None = None, bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                       fill: dict | None = None) -> DataFrame:
    """As-of left join of ``entities`` to every view in ``views``.

    Output: every entity column (in order) followed by each view's fields.
    ``fill`` maps feature column → value for missing features (PRJ-7); it only
    touches feature columns.

    A key's rows are spread over its time buckets, and entity rows without a key, which
    match nothing, by a hash of the row: neither meets in one task.
    """
    if not views:
        return entities
    keys = tuple(keys or views[0].keys)
    for v in views:
        if tuple(v.keys) != keys:
            raise ValueError(f"view {v.name} keys {v.keys} differ from {keys}")
    out_fields = [f for v in views for f in v.fields]
    clash = set(out_fields) & set(entities.columns)
    if clash:
        raise ValueError(f"feature columns clash with entity columns: {sorted(clash)}")

    W = int(bucket_seconds)
    vnames = [f"_v{i}" for i in range(len(views))]
    ent_cols = entities.columns

    def vstruct(v: FeatureView) -> Column:
        created = F.col(v.created_col) if v.created_col and v.created_col in v.df.columns else F.lit(None).cast("timestamp")
        return F.struct(_ntz(v.ts_col).alias("_fts"), created.cast("timestamp").alias("_fcreated"),
                        *[F.col(f) for f in v.fields])

    vtypes = [views[i].df.select(vstruct(views[i]).alias("s")).schema["s"].dataType for i in range(len(views))]
    etype = entities.select(F.struct(*[F.col(c) for c in ent_cols]).alias("e")).schema["e"].dataType

    def row(ts: Column, kind: int, created: Column, ttl: int, e: Column | None, vi: int | None,
            vs: Column | None, key_cols: list[Column]) -> list[Column]:
        cols = list(key_cols) + [
            ts.alias("_ts"), F.lit(kind).alias("_kind"), created.cast("timestamp").alias("_ord"),
            F.lit(int(ttl)).cast("long").alias("_ttl"),
            (e if e is not None else F.lit(None).cast(etype)).alias("_e"),
        ]
        for j, n in enumerate(vnames):
            cols.append((vs if j == vi else F.lit(None).cast(vtypes[j])).alias(n))
        return cols

    ets = _ntz(entity_ts)
    parts = [entities.select(*row(ets, 1, F.lit(None), 0, F.struct(*[F.col(c) for c in ent_cols]), None, None,
                                  [F.col(k) for k in keys]))]
    for i, v in enumerate(views):
        f = v.df.where(F.col(v.ts_col).isNotNull())
        for k in keys:
            f = f.where(F.col(k).isNotNull())
        parts.append(f.select(*row(_ntz(v.ts_col), 0, vstruct(v)["_fcreated"], v.ttl_seconds, None, i, vstruct(v),
                                   [F.col(k) for k in keys])))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # one projection assigns buckets: every row goes to its own bucket and, as carry-in, to each later bucket that
    # starts within its TTL (entity rows have TTL 0; a null time keeps its row; a row without a key goes anywhere)
    sec = epoch_seconds(F.col("_ts"))
    own = F.floor(sec / F.lit(W))
    reach = F.floor((sec + F.col("_ttl")) / F.lit(W))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    buckets = F.when(no_key, F.array(F.xxhash64("_e", "_ts"))).otherwise(F.sequence(own, F.greatest(reach, own)))
    u = u.withColumn("_bucket", F.explode_outer(buckets)).drop("_ttl")

    w = (Window.partitionBy(*keys, "_bucket").orderBy("_ts", "_kind", "_ord")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for n in vnames:
        u = u.withColumn(n, F.last(n, ignorenulls=True).over(w))
    u = u.where(F.col("_kind") == 1)

    sel = [F.col(f"_e.{c}").alias(c) for c in ent_cols]
    for i, v in enumerate(views):
        fresh = F.col(f"{vnames[i]}._fts") >= F.timestamp_add("SECOND", F.lit(-int(v.ttl_seconds)), F.col("_ts"))
        for fname in v.fields:
            val = F.when(fresh, F.col(f"{vnames[i]}.{fname}"))
            if fill and fname in fill:
                val = F.coalesce(val, F.lit(fill[fname]))
            sel.append(val.alias(fname))
    return u.select(*sel)


def latest_per_key(df: DataFrame, keys=("card_id",), ts: str = "event_timestamp",
                   created: str | None = "created_timestamp", cols: list[str] | None = None) -> DataFrame:
    """WIN-3: newest row per key by (ts, created) — one ``max_by`` aggregate
    with map-side partial aggregation (Spark plans it as a sort-based
    aggregate because the buffer is a struct), no window."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = cols or [c for c in df.columns if c not in keys]
    order = [F.col(ts)] + ([F.col(created)] if created and created in df.columns else [])
    packed = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, F.struct(*order)).alias("_r"))
              .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def lookup_latest(requests: DataFrame, latest: DataFrame, fields: list[str], keys=("card_id",),
                  ts: str = "event_timestamp", as_of: str | None = None, ttl_seconds: int | None = None,
                  bounded_requests: bool = False) -> DataFrame:
    """SNK-9 / JOIN-5: left join requested keys to the latest-per-key table.

    With ``as_of`` and ``ttl_seconds``, a latest row older than
    ``as_of - ttl`` or newer than ``as_of`` counts as missing (TTL applied at read).  Request rows are
    all kept.  The latest table has one row per key, so this is a plain
    equi-join that Spark broadcasts only when AQE measures it small.  With
    ``bounded_requests`` (a micro-batch of known maximum size) the table is
    first cut down to the requested keys by a broadcast semi join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    lat = latest.select(*keys, F.col(ts).alias("_latest_ts"), *fields)
    if bounded_requests:
        # a micro-batch has a bounded number of rows (maxOffsetsPerTrigger): broadcast
        # its distinct keys and semi-join the big table by them — a scan, no shuffle of it
        wanted = requests.select(*keys).where(F.col(keys[0]).isNotNull()).distinct()
        lat = lat.join(F.broadcast(wanted), on=keys, how="left_semi")
    j = requests.join(lat, on=keys, how="left")
    if as_of is not None and ttl_seconds is not None:
        fresh = F.col("_latest_ts").between(F.timestamp_add("SECOND", F.lit(-int(ttl_seconds)), _ntz(as_of)), _ntz(as_of))
        for f in fields:
            j = j.withColumn(f, F.when(fresh, F.col(f)))
    return j.drop("_latest_ts")
