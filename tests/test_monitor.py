"""Monitoring: gaps against a dense minute spine, held alerts, panes against sliding windows; plans."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from payrisk.operators import monitor

START = datetime(2024, 1, 1, 22, 30)
MINUTE = timedelta(minutes=1)


def _log(spark, rows):
    return spark.createDataFrame([(t, d) for t, d in rows], "ts timestamp_ntz, decision string")


def _dense(rows, idle_minutes=5, hold=10):
    """Idle times by walking over every minute of the log."""
    rows = [(t.replace(second=0, microsecond=0), d) for t, d in rows if t is not None]
    if not rows:
        return []
    lo, hi = min(t for t, _ in rows), max(t for t, _ in rows)
    seen = {t for t, d in rows if d is not None}
    out, at, run, quiet, k = [], lo, None, 0, 0
    while at <= hi:
        quiet = 0 if at in seen else quiet + 1
        if quiet >= idle_minutes:
            run = run or [at, at, 0, None, 0]
            run[1], run[2] = at, run[2] + 1
            if run[2] > hold:
                run[3], run[4] = run[3] or at, run[4] + 1
        elif run:
            out.append(tuple(run))
            run = None
        at += MINUTE
    return sorted(out + ([tuple(run)] if run else []))


@pytest.mark.parametrize("seed", range(4))
def test_gaps_against_a_dense_spine(spark, seed):
    """Gaps across midnights, one of over five days, heads and tails with errors only, minutes with many rows."""
    rng = random.Random(seed)
    rows, at = [(START - MINUTE * rng.randint(0, 30), None)], START
    for k in range(60):
        at += timedelta(seconds=rng.choice([5, 50, 200, 290, 310, 600, 900, 960, 4000, 40000])) + (timedelta(days=5, hours=3) if k == 30 else timedelta())
        rows.append((at, rng.choice(["approve", "fraud", None])))
    rows += [(at + MINUTE * rng.randint(0, 30), None), (None, "approve")]
    got = sorted(map(tuple, monitor.idle_gaps(_log(spark, rows).repartition(3)).collect()))
    assert got == _dense(rows)
    assert any(r[2] > 5 * 1440 for r in got)
    assert sorted(map(tuple, monitor.idle_episodes(_log(spark, rows)).collect())) == [(r[3], r[1], r[4]) for r in got if r[4]]


def test_gaps_of_logs_without_predictions(spark):
    assert monitor.idle_gaps(_log(spark, [])).collect() == []
    assert monitor.idle_gaps(_log(spark, [(START, "approve")])).collect() == []
    rows = [(START, None), (START + 20 * MINUTE, None)]
    assert list(map(tuple, monitor.idle_gaps(_log(spark, rows)).collect())) == _dense(rows)


@pytest.mark.parametrize("held", [0, 2, 10])
def test_held_alerts(spark, held):
    rng = random.Random(held)
    alerts = {START + MINUTE * i: rng.random() < 0.9 for i in range(200) if rng.random() < 0.95}
    df = spark.createDataFrame([(t, a, "x") for t, a in alerts.items()], "window_start timestamp_ntz, alert boolean, more string")
    got = {r["window_start"]: r["firing"] for r in monitor.with_firing(df, held_minutes=held).collect()}
    assert got == {t: all(alerts.get(t - MINUTE * k, False) for k in range(held + 1)) for t in alerts}


def test_panes_make_sliding_windows(spark):
    rng = random.Random(1)
    rows = [(START + timedelta(seconds=rng.randint(0, 3000)), rng.choice(["ok", "error"])) for _ in range(500)] + [(None, "ok")]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, status string")
    for width, slide in (("2 minutes", "1 minute"), ("5 minutes", "1 minute"), ("6 minutes", "2 minutes")):
        want = log.groupBy(F.window("ts", width, slide).start.alias("window_start")).agg(F.count("*").alias("n"))
        got = monitor.sliding(log, {"n": F.count("*")}, width, slide)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.where("window_start is not null").collect()))


@pytest.mark.parametrize("name", ["error_ratio_2m", "latency_quantiles", "missing_alert"])
def test_plans_scan_once_without_windows(spark, name):
    from payrisk.plans.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window [" not in plan and "SinglePartition" not in plan


def test_gaps_are_windowed_by_day_only(spark):
    plan = monitor.idle_gaps(_log(spark, [(START, "approve")]))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("], [day#" in line for line in windows)


def test_idle_alert_has_every_minute(spark):
    """Every minute of the log is a row, those of a five-day outage too, and only heads and tails without a full span are not idle."""
    rng = random.Random(7)
    rows, at = [(START, None)], START + 9 * MINUTE
    for k in range(40):
        at += timedelta(seconds=rng.choice([5, 50, 200, 310, 900, 960, 4000])) + (timedelta(days=5) if k == 20 else timedelta())
        rows.append((at, rng.choice(["approve", "fraud", None])))
    rows += [(at + 20 * MINUTE, None), (None, "approve")]
    minutes = [t.replace(second=0, microsecond=0) for t, _ in rows if t]
    span = int((max(minutes) - START) / MINUTE) + 1
    n = [0] * span
    for m, (t, d) in zip(minutes, rows):
        n[int((m - START) / MINUTE)] += d is not None
    idle = [i >= 4 and not any(n[i - 4:i + 1]) for i in range(span)]
    want = [(START + i * MINUTE, n[i], sum(n[max(0, i - 4):i + 1]), idle[i], i >= 10 and all(idle[i - 10:i + 1])) for i in range(span)]
    assert sorted(map(tuple, monitor.idle_alert(_log(spark, rows).repartition(3)).collect())) == want
    assert span > 5 * 1440 and monitor.idle_alert(_log(spark, [])).collect() == []


def test_idle_gaps_query_is_by_minute(spark):
    from payrisk.plans.registry import QUERIES

    out = QUERIES["idle_gaps"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["minute", "n", "n_last", "idle", "firing"]
    lo, hi, rows = out.selectExpr("min(minute)", "max(minute)", "count(*)").first()
    assert rows == (hi - lo) / MINUTE + 1
