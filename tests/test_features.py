"""Window features: edges, parity with pandas, geo flag."""
from datetime import datetime


from payrisk.operators.velocity import card_velocity_1m, geo_change_flag


def test_window_edges(spark):
    rows = [("a", datetime(2024, 1, 1, 0, 0, 0), 1.0), ("a", datetime(2024, 1, 1, 0, 0, 59, 999000), 2.0),
            ("a", datetime(2024, 1, 1, 0, 1, 0), 4.0)]
    df = spark.createDataFrame(rows, "card_id string, event_timestamp timestamp_ntz, amount double")
    got = {r["event_timestamp"]: (r["txn_count_1m"], r["amount_sum_1m"]) for r in card_velocity_1m(df).collect()}
    assert got == {datetime(2024, 1, 1, 0, 1): (2, 3.0), datetime(2024, 1, 1, 0, 2): (1, 4.0)}


def test_nulls_dropped_before_grouping(spark):
    rows = [("a", datetime(2024, 1, 1), None), (None, datetime(2024, 1, 1), 1.0), ("a", datetime(2024, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "card_id string, event_timestamp timestamp_ntz, amount double")
    r = card_velocity_1m(df).collect()
    assert len(r) == 1 and r[0]["txn_count_1m"] == 1 and r[0]["amount_sum_1m"] == 2.0


def test_velocity_matches_pandas(spark):
    from payrisk.sources.fixtures import payments

    pay = payments(spark, "/root/testdata/sf0.001")
    pdf = pay.select("card_id", "event_timestamp", "amount").toPandas()
    pdf["end"] = pdf["event_timestamp"].dt.floor("min") + __import__("pandas").Timedelta(minutes=1)
    exp = pdf.groupby(["card_id", "end"]).agg(n=("amount", "count"), s=("amount", "sum")).reset_index()
    got = card_velocity_1m(pay).toPandas()
    assert len(got) == len(exp)
    assert got["txn_count_1m"].sum() == exp["n"].sum()
    assert abs(got["amount_sum_1m"].sum() - exp["s"].sum()) < 1e-6


def test_geo_change_bucket_independent(spark):
    rows = [("1", "a", datetime(2024, 1, 1, 23, 58), "US"), ("2", "a", datetime(2024, 1, 2, 0, 1), "GB"),
            ("3", "a", datetime(2024, 1, 2, 0, 2), "GB"), ("4", "a", datetime(2024, 1, 2, 0, 10), "GB"),
            ("5", "a", datetime(2024, 1, 2, 0, 12), "US")]
    df = spark.createDataFrame(rows, "event_id string, card_id string, event_timestamp timestamp_ntz, country string")
    for b in (60, 3600, 86400):
        got = {r["event_id"]: r["geo_change_flag_5m"] for r in geo_change_flag(df, bucket_seconds=b).collect()}
        assert got == {"1": 0, "2": 1, "3": 1, "4": 0, "5": 1}, b
