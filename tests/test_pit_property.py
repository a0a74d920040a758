"""Property test: the point-in-time join equals a brute-force as-of join."""
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from payrisk.operators.pit import FeatureView, point_in_time_join

T0 = datetime(2024, 1, 1)
KEYS = ["a", "b", "c", None]


def brute(feats, ents, ttl):
    out = {}
    for rid, k, t in ents:
        cands = [f for f in feats if k is not None and f[0] == k and f[1] <= t]
        if not cands:
            out[rid] = None
            continue
        best = max(cands, key=lambda f: (f[1], f[2]))
        out[rid] = best[3] if best[1] >= t - timedelta(seconds=ttl) else None
    return out


feat_rows = st.lists(st.tuples(st.sampled_from(KEYS[:3]), st.integers(0, 400), st.integers(0, 5)), max_size=25)
ent_rows = st.lists(st.tuples(st.sampled_from(KEYS), st.integers(0, 400)), min_size=1, max_size=25)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feat_rows, ent_rows, st.sampled_from([60, 600, 3600]), st.sampled_from([120, 300, 1800, 86400]))
def test_matches_brute_force(spark, fr, er, ttl, bucket):
    # minutes from T0; created times make ties on the feature time resolvable
    feats = [(k, T0 + timedelta(minutes=m), T0 + timedelta(seconds=c), i) for i, (k, m, c) in enumerate(fr)]
    # unique (key, time, created): duplicates in both would make the winner arbitrary
    seen, uniq = set(), []
    for f in feats:
        if (f[0], f[1], f[2]) not in seen:
            seen.add((f[0], f[1], f[2]))
            uniq.append(f)
    ents = [(i, k, T0 + timedelta(minutes=m)) for i, (k, m) in enumerate(er)]
    fdf = spark.createDataFrame(uniq or [("a", T0, T0, -1)][:0],
                                "card_id string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, f long")
    edf = spark.createDataFrame(ents, "rid long, card_id string, event_timestamp timestamp_ntz")
    v = FeatureView("v", fdf, ("f",), ttl)
    got = {r["rid"]: r["f"] for r in point_in_time_join(edf, [v], bucket_seconds=bucket).collect()}
    assert got == brute(uniq, ents, ttl)
