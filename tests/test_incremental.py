"""Feature tables after each delivery equal the features of all rows delivered so far."""
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from payrisk.operators.pit import FeatureView, point_in_time_join
from payrisk.operators.velocity import card_velocity_1m, card_velocity_5m
from payrisk.streaming.incremental import day_ranges, read_view, start_views, update_views

SCHEMA = "card_id string, event_timestamp timestamp_ntz, amount double, extra string"


def _rows(df, fields):
    return sorted(tuple(r) for r in df.select("card_id", "event_timestamp", *fields).collect())


@pytest.fixture()
def deliveries():
    at = datetime
    return [
        [("a", at(2024, 1, 1, 0, 0, 10), 1.0, "x"), ("a", at(2024, 1, 1, 0, 3), 2.0, "x"), ("b", at(2024, 1, 2, 9, 0), 4.0, None),
         (None, at(2024, 1, 1), 1.0, "x"), ("a", None, 1.0, "x")],
        [("b", at(2024, 1, 9, 9, 0), 8.0, "x"), ("a", at(2024, 1, 1, 0, 0, 50), 16.0, "x"), ("a", at(2024, 1, 1, 0, 0, 50), 16.0, "x")],
        [("b", at(2024, 1, 2, 9, 0, 59), 32.0, "x"), ("b", at(2024, 1, 2, 9, 1), None, "x")],
    ]


def test_equals_full_computation_after_each_delivery(spark, tmp_dir, deliveries):
    schema = spark.createDataFrame([], SCHEMA).schema
    sizes = []
    for i, rows in enumerate(deliveries):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_dir}/in")
        for _ in range(2):  # the second start finds nothing new
            start_views(spark, f"{tmp_dir}/in", schema, f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()
        pay = spark.read.parquet(f"{tmp_dir}/in")
        assert _rows(read_view(spark, f"{tmp_dir}/out", "1m"), ["txn_count_1m", "amount_sum_1m"]) == \
            _rows(card_velocity_1m(pay), ["txn_count_1m", "amount_sum_1m"])
        assert _rows(read_view(spark, f"{tmp_dir}/out", "5m"), ["txn_count_5m", "avg_transaction_amount_5m"]) == \
            _rows(card_velocity_5m(pay), ["txn_count_5m", "avg_transaction_amount_5m"])
        sizes.append(spark.read.parquet(f"{tmp_dir}/out/1m").count())
    assert sizes == [3, 5, 6]  # three windows, two of which one is new, one that a late row touches


def test_a_batch_run_again_changes_nothing(spark, tmp_dir, deliveries):
    all_rows = spark.createDataFrame(sum(deliveries, []), SCHEMA)
    last = spark.createDataFrame(deliveries[2], SCHEMA)
    for _ in range(2):
        update_views(last, 7, all_rows, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/1m").count() == 1
    assert read_view(spark, tmp_dir, "1m").first()["amount_sum_1m"] == 36.0


def test_point_in_time_join_takes_the_table_as_it_is(spark, tmp_dir, deliveries):
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in deliveries:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_dir}/in")
        start_views(spark, f"{tmp_dir}/in", schema, f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()
    fields = ("txn_count_1m", "amount_sum_1m")
    ent = spark.read.parquet(f"{tmp_dir}/in").select("card_id", F.timestamp_add("MINUTE", F.lit(3), "event_timestamp").alias("event_timestamp"))
    tables = (spark.read.parquet(f"{tmp_dir}/out/1m"), card_velocity_1m(spark.read.parquet(f"{tmp_dir}/in")))
    got, want = (point_in_time_join(ent, [FeatureView("v", t, fields, 7200)]) for t in tables)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_day_ranges():
    days = [date(2024, 1, d) for d in (5, 1, 2, 9)]
    assert day_ranges(days) == [(date(2024, 1, 1), date(2024, 1, 3)), (date(2024, 1, 5), date(2024, 1, 6)), (date(2024, 1, 9), date(2024, 1, 10))]
    assert day_ranges(days, 2) == [(date(2024, 1, 1), date(2024, 1, 10))]


def test_only_touched_days_are_read(spark, tmp_dir, deliveries):
    from payrisk.streaming.incremental import within

    spark.createDataFrame(deliveries[0], SCHEMA).write.parquet(f"{tmp_dir}/in")
    df = spark.read.parquet(f"{tmp_dir}/in").where(within("event_timestamp", [(date(2024, 1, 1), date(2024, 1, 2))]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "LessThan(event" in plan
    assert df.count() == 3
