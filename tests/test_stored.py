"""Stored, bucketed features: the join equals the window form, its feature side is not shuffled, one card reads one bucket."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from payrisk.operators.pit import FeatureView, point_in_time_join
from payrisk.operators.stored import StoredView, buckets_for, join_stored, store_view
from payrisk.plans import registry
from payrisk.plans.features import velocity_views
from payrisk.sources import fixtures
from payrisk.sources.bucketed import _name, read_buckets, write_buckets

FILL = {"txn_count_1m": 0, "amount_sum_1m": 0.0}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("seconds", [600, 3600, 86400])
def test_equals_the_window_form(spark, tmp_dir, seconds):
    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    views = velocity_views(pay, F.current_timestamp())
    stored = [store_view(v, f"{tmp_dir}/{v.name}", 4, seconds) for v in views]
    ent = pay.select("event_id", "card_id", "event_timestamp", "amount")
    ent = ent.unionByName(ent.limit(20).withColumn("card_id", F.lit(None).cast("string"))).unionByName(ent.where("event_id = '1'"))
    assert _rows(join_stored(ent, stored, fill=FILL)) == _rows(point_in_time_join(ent, views, fill=FILL))


def test_ttl_edge_ties_and_odd_rows(spark, tmp_dir):
    t = datetime(2024, 1, 1, 12)
    feats = [("a", t, datetime(2024, 1, 2), 1), ("a", t, datetime(2024, 1, 3), 2), ("a", t + timedelta(minutes=30), datetime(2024, 1, 2), None),
             (None, t, datetime(2024, 1, 2), 9), ("a", None, datetime(2024, 1, 2), 9)]
    f = spark.createDataFrame(feats, "card_id string, event_timestamp timestamp_ntz, created_timestamp timestamp, v int")
    view = FeatureView("v", f, ("v",), 7200)
    ent = spark.createDataFrame([("a", t), ("a", t + timedelta(hours=2, minutes=30)), ("a", t + timedelta(hours=2, minutes=31)), ("a", None), (None, t),
                                 ("a", t - timedelta(seconds=1)), ("z", t)], "card_id string, event_timestamp timestamp_ntz")
    want = _rows(point_in_time_join(ent, [view]))
    for w in (60, 3600):
        assert _rows(join_stored(ent, [store_view(view, f"{tmp_dir}/{w}", 3, w)])) == want
    empty = FeatureView("v", f.limit(0), ("v",), 7200)
    assert join_stored(ent, [store_view(empty, f"{tmp_dir}/empty", 2)]).where("v is not null").count() == 0
    with pytest.raises(ValueError):
        join_stored(ent.withColumn("v", F.lit(1)), [store_view(view, f"{tmp_dir}/clash", 2)])


def test_feature_side_is_not_shuffled(spark, tmp_dir):
    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    stored = [store_view(v, f"{tmp_dir}/{v.name}", 4) for v in velocity_views(pay)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        plan = _plan(join_stored(pay.select("event_id", "card_id", "event_timestamp"), stored))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 1  # the entity rows, once for both views
    assert plan.count("Bucketed: true") == 2


def test_one_key_reads_one_bucket_also_in_a_later_session(spark, tmp_dir):
    df = spark.range(1000).selectExpr("concat('card_', id) as card_id", "id as v")
    write_buckets(df, tmp_dir + "/t", ["card_id"], 16)
    spark.sql(f"DROP TABLE {_name(tmp_dir + '/t')}")  # an external table: the files stay
    one = read_buckets(spark, tmp_dir + "/t", ["card_id"]).where("card_id = 'card_77'")
    assert [r["v"] for r in one.collect()] == [77]
    # the scan prunes files either way; the count is shown where the scan keeps its buckets apart
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        shown = _plan(read_buckets(spark, tmp_dir + "/t", ["card_id"]).where("card_id = 'card_77'"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in shown


def test_a_stored_view_is_found_by_its_path(spark, tmp_dir):
    f = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], "card_id string, event_timestamp timestamp_ntz, v int")
    store_view(FeatureView("v", f, ("v",), 60), tmp_dir + "/v", 2)
    spark.sql(f"DROP TABLE {_name(StoredView(tmp_dir + '/v', ('v',), 60).folder)}")
    assert join_stored(f.select("card_id", "event_timestamp"), [StoredView(tmp_dir + "/v", ("v",), 60)]).first()["v"] == 1


def test_published_online_table(spark, tmp_dir):
    from payrisk.streaming import online

    pay = fixtures.payments(spark, "/root/testdata/sf0.001")
    velocity_views(pay, F.current_timestamp())[0].df.write.parquet(f"{tmp_dir}/f1")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_dir}/f1").schema).parquet(f"{tmp_dir}/f1")
    assert online.publish_online(spark, f"{tmp_dir}/ckpt", f"{tmp_dir}/pub") is None
    online.start_online(stream, f"{tmp_dir}/ckpt", {"availableNow": True}).awaitTermination()
    table = online.publish_online(spark, f"{tmp_dir}/ckpt", f"{tmp_dir}/pub", 8)
    assert _rows(table.select("card_id", "txn_count_1m")) == _rows(online.read_online(spark, f"{tmp_dir}/ckpt").select("card_id", "txn_count_1m"))
    card = table.first()["card_id"]
    assert [r["card_id"] for r in online.read_card(spark, f"{tmp_dir}/pub", card).collect()] == [card]
    assert online.read_card(spark, f"{tmp_dir}/pub", "nobody").count() == 0


def test_buckets_grow_with_the_rows(spark, tmp_dir):
    views = velocity_views(fixtures.payments(spark, "/root/testdata/sf0.001"))
    few, many = (buckets_for(n, views) for n in (1000, 36_000_000))
    assert few == 8 and 36_000_000 * 5 / many <= 1_000_000
    one, several = (join_stored(views[0].df.select("card_id", "event_timestamp"), [store_view(v, f"{tmp_dir}/{n}/{v.name}", n) for v in views]) for n in (8, 19))
    assert _rows(one) == _rows(several)


def test_the_query_takes_buckets_by_rows(spark, monkeypatch):
    taken, store = [], registry.stored.store_view
    monkeypatch.setattr(registry.stored, "store_view", lambda v, path, buckets: taken.append(buckets) or store(v, path, buckets))
    monkeypatch.setattr(registry.stored, "BUCKET_ENTRIES", 300)
    rows = registry.QUERIES["pit_1m_5m_stored"](spark, "/root/testdata/sf0.001").count()
    assert rows == fixtures.payments(spark, "/root/testdata/sf0.001").count() and taken[0] == taken[1] == -(-rows * 5 // 300)
