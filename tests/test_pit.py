"""Point-in-time join: FIXTURES §3 hand cases, invariants, bucket independence."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from payrisk.operators.pit import FeatureView, latest_per_key, lookup_latest, point_in_time_join

T0 = datetime(2024, 1, 1, 12, 0, 0)


def _feat(spark, rows):
    return spark.createDataFrame(rows, "card_id string, event_timestamp timestamp_ntz, created_timestamp timestamp, f long")


def _ent(spark, rows):
    return spark.createDataFrame(rows, "rid int, card_id string, event_timestamp timestamp_ntz")


def _join(spark, feats, ents, ttl=7200, bucket=86400):
    v = FeatureView("v", _feat(spark, feats), ("f",), ttl)
    out = point_in_time_join(_ent(spark, ents), [v], bucket_seconds=bucket)
    return {r["rid"]: r["f"] for r in out.collect()}, out


@pytest.mark.parametrize("bucket", [60, 3600, 86400])
def test_exact_time_ttl_edge_future(spark, bucket):
    c = datetime(2024, 1, 1)
    feats = [("a", T0, c, 1),
             ("b", T0 - timedelta(minutes=120), c, 2),
             ("c", T0 - timedelta(minutes=120, microseconds=1), c, 3),
             ("d", T0 + timedelta(microseconds=1), c, 4)]
    ents = [(1, "a", T0), (2, "b", T0), (3, "c", T0), (4, "d", T0)]
    got, _ = _join(spark, feats, ents, bucket=bucket)
    assert got == {1: 1, 2: 2, 3: None, 4: None}


def test_tie_newest_created_wins(spark):
    feats = [("a", T0, datetime(2024, 1, 1, 1), 1), ("a", T0, datetime(2024, 1, 1, 2), 2)]
    got, _ = _join(spark, feats, [(1, "a", T0)])
    assert got == {1: 2}


def test_duplicates_and_null_key_kept(spark):
    feats = [("a", T0, datetime(2024, 1, 1), 7)]
    ents = [(1, "a", T0), (2, "a", T0), (3, None, T0)]
    got, out = _join(spark, feats, ents)
    assert out.count() == 3
    assert got == {1: 7, 2: 7, 3: None}


def test_newest_older_feature_wins_across_buckets(spark):
    c = datetime(2024, 1, 1)
    feats = [("a", T0 - timedelta(minutes=90), c, 1), ("a", T0 - timedelta(minutes=30), c, 2),
             ("a", T0 + timedelta(minutes=5), c, 3)]
    ents = [(1, "a", T0), (2, "a", T0 - timedelta(minutes=60)), (3, "a", T0 + timedelta(minutes=200))]
    for bucket in (60, 600, 3600, 86400):
        got, _ = _join(spark, feats, ents, bucket=bucket)
        assert got == {1: 2, 2: 1, 3: None}, bucket


def test_invariants_on_driver_table(spark):
    from payrisk.plans.features import velocity_views
    from payrisk.sources.fixtures import payments

    pay = payments(spark, "/root/testdata/sf0.01")
    v1 = velocity_views(pay)[0]
    v1ts = v1.df.select("card_id", F.col("event_timestamp").alias("fts"), "txn_count_1m", "amount_sum_1m")
    ent = pay.select("event_id", "card_id", "event_timestamp")
    out = point_in_time_join(ent, [v1])
    assert out.count() == pay.count()
    # every matched feature row exists, is not later than the entity and within TTL
    j = out.where(F.col("txn_count_1m").isNotNull()).join(
        v1ts, ["card_id", "txn_count_1m", "amount_sum_1m"])
    bad = j.groupBy("event_id").agg(
        F.max(F.when((F.col("fts") <= F.col("event_timestamp"))
                     & (F.col("fts") >= F.col("event_timestamp") - F.expr("INTERVAL 120 MINUTES")), 1)
              .otherwise(0)).alias("ok")).where("ok = 0")
    assert bad.count() == 0
    # bucket width does not change the result
    a = point_in_time_join(ent, [v1], bucket_seconds=3600).exceptAll(point_in_time_join(ent, [v1], bucket_seconds=86400 * 7))
    assert a.count() == 0


def test_latest_and_lookup(spark):
    rows = [("a", T0, datetime(2024, 1, 1, 1), 1), ("a", T0, datetime(2024, 1, 1, 2), 2),
            ("a", T0 - timedelta(hours=1), datetime(2024, 1, 1, 3), 3), ("b", T0, datetime(2024, 1, 1), 4)]
    lat = latest_per_key(_feat(spark, rows))
    assert {r["card_id"]: r["f"] for r in lat.collect()} == {"a": 2, "b": 4}
    req = spark.createDataFrame([("a",), ("z",)], "card_id string").withColumn(
        "as_of", F.lit(T0 + timedelta(hours=3)).cast("timestamp_ntz"))
    got = {r["card_id"]: r["f"] for r in lookup_latest(req, lat, ["f"]).collect()}
    assert got == {"a": 2, "z": None}
    got = {r["card_id"]: r["f"] for r in lookup_latest(req, lat, ["f"], as_of="as_of", ttl_seconds=7200).collect()}
    assert got == {"a": None, "z": None}


def test_buckets_do_not_change_the_join(spark):
    """Narrow buckets (a hot card's rows in many tasks) give the same join as wide ones; rows without a key stay, unmatched."""
    from pyspark.sql import functions as F

    from payrisk.plans.features import velocity_views
    from payrisk.sources.fixtures import payments

    pay = payments(spark, "/root/testdata/sf0.01")
    n = F.col("event_id").cast("long")
    hot = pay.withColumn("card_id", F.when(n % 2 == 0, F.lit("hot")).when(n % 10 < 4, F.lit(None)).otherwise(F.col("card_id")))
    views = velocity_views(hot)
    ent = hot.select("event_id", "card_id", "event_timestamp")
    base = point_in_time_join(ent, views, bucket_seconds=86400 * 40)
    for width in (600, 3600, 6 * 3600):
        got = point_in_time_join(ent, views, bucket_seconds=width)
        assert got.exceptAll(base).count() == 0 and base.exceptAll(got).count() == 0, width
    lost = base.where("card_id is null")
    assert lost.count() > 0 and lost.where("txn_count_1m is not null or txn_count_5m is not null").count() == 0
