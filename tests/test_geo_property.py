"""Property test: the bucketed geo-change flag equals a brute-force definition."""
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from payrisk.operators.velocity import geo_change_flag

T0 = datetime(2024, 1, 1, 23, 50)


def brute(rows, within=300):
    out = {}
    for eid, card, t, c in rows:
        earlier = [r for r in rows if r[1] == card and (r[2], r[0]) < (t, eid)
                   and r[2] >= t - timedelta(seconds=within) and r[3] != c]
        out[eid] = 1 if earlier else 0
    return out


rows_st = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 1800), st.sampled_from(["US", "GB", "IN"])),
                   min_size=1, max_size=30)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st, st.sampled_from([60, 300, 3600, 86400]))
def test_matches_brute_force(spark, rs, bucket):
    rows = [(f"{i:03d}", card, T0 + timedelta(seconds=s), c) for i, (card, s, c) in enumerate(rs)]
    df = spark.createDataFrame(rows, "event_id string, card_id string, event_timestamp timestamp_ntz, country string")
    got = {r["event_id"]: r["geo_change_flag_5m"] for r in geo_change_flag(df, bucket_seconds=bucket).collect()}
    assert got == brute(rows)
