"""Property tests: exact newest-N and bounded exact quantiles against Python."""
from datetime import datetime, timedelta

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from payrisk.operators.quantiles import exact_quantiles
from payrisk.operators.topk import tail_by_time

T0 = datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(0, 600), min_size=1, max_size=80), st.integers(1, 100), st.sampled_from([1, 60, 3600]))
def test_tail_matches_sorted(spark, secs, n, bucket):
    rows = [(f"e{i:03d}", T0 + timedelta(seconds=s)) for i, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "event_id string, ts timestamp_ntz")
    got = sorted((r["event_id"], r["ts"]) for r in tail_by_time(df, n, "ts", ("event_id",), bucket).collect())
    exp = sorted(sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)[:n])
    assert got == exp


@SETTINGS
@given(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1,
                max_size=120))
def test_quantiles_match_numpy(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.13, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, "x", probs)
    assert np.allclose(got, np.quantile(np.array(vals), probs), rtol=1e-12, atol=1e-9)
