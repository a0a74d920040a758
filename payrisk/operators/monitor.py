"""Monitoring questions as windowed aggregates over the scored-event log (MON-1..8).

The reference keeps these as service counters scraped by a metrics server; a
Spark user asks the same questions of the prediction log.  A counter rate
``rate(c[w])`` becomes count-in-window / w seconds.  All are group-bys on
(event-time window, label).  Sliding windows are sums of neighbouring panes,
one pane a slide, so events are aggregated once; held alerts are counts over
the panes before; idle times are the gaps between minutes that have predictions.
No window is unpartitioned; only ``idle_alert`` makes the minutes without rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk import schemas as S

LE_LABELS = [repr(b) for b in S.LATENCY_BUCKETS] + ["+Inf"]


def _seconds(width: str) -> int:
    n, unit = width.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def decisions_per_window(log: DataFrame, width: str = "1 minute") -> DataFrame:
    """MON-1: predictions per decision per window and the per-second rate."""
    w = F.window("ts", width)
    return (log.where(F.col("decision").isNotNull())
               .groupBy(w.start.alias("window_start"), "decision")
               .agg(F.count(F.lit(1)).alias("n"))
               .withColumn("rate_per_s", F.col("n") / F.lit(float(_seconds(width)))))


def request_rates(log: DataFrame, width: str = "1 minute") -> DataFrame:
    """MON-2: requests by status per window and the per-second rate."""
    return (log.groupBy(F.window("ts", width).start.alias("window_start"), "status")
               .agg(F.count(F.lit(1)).alias("n"))
               .withColumn("rate_per_s", F.col("n") / F.lit(float(_seconds(width)))))


def sliding(log: DataFrame, sums: dict[str, Column], width: str = "2 minutes", slide: str = "1 minute") -> DataFrame:
    """(window_start, sums..) per sliding window: every event goes into one pane as long as the slide, and a window is
    the sum of its panes.  ``sums`` are aggregates that add up (counts and sums)."""
    panes = log.where(F.col("ts").isNotNull()).groupBy(F.window("ts", slide).start.alias("_pane")).agg(*[c.alias(n) for n, c in sums.items()])
    back = F.explode(F.sequence(F.lit(0), F.lit(_seconds(width) // _seconds(slide) - 1))).alias("_k")
    start = F.col("_pane") - F.make_dt_interval(secs=F.col("_k") * _seconds(slide))
    return panes.select("*", back).groupBy(start.alias("window_start")).agg(*[F.sum(n).cast("long").alias(n) for n in sums])


def error_ratio(log: DataFrame, width: str = "2 minutes", slide: str = "1 minute", floor: float = 0.001,
                limit: float = 0.05) -> DataFrame:
    """MON-2: per sliding window, ok and error request rates, error ratio
    ``e / max(e + o, floor)`` and the alert condition ratio > limit."""
    secs = float(_seconds(width))
    agg = sliding(log, {f"n_{s}": F.sum(F.when(F.col("status") == s, 1).otherwise(0)) for s in ("ok", "error")}, width, slide)
    e, o = F.col("n_error") / F.lit(secs), F.col("n_ok") / F.lit(secs)
    ratio = e / F.greatest(e + o, F.lit(floor))
    return agg.withColumn("error_ratio", ratio).withColumn("alert", F.col("error_ratio") > F.lit(limit))


def _cum_counts(latency_s: Column) -> list[Column]:
    return ([F.sum(F.when(latency_s <= F.lit(b), 1).otherwise(0)).cast("long") for b in S.LATENCY_BUCKETS]
            + [F.count(F.lit(1))])


def latency_histogram(log: DataFrame, width: str = "1 hour") -> DataFrame:
    """MON-3: cumulative latency histogram (``le`` buckets, seconds) per window,
    successful scorings only.  Long form: window_start, le, cum_count."""
    lat = F.col("latency_ms") / F.lit(1000.0)
    w = F.window("ts", width)
    cums = _cum_counts(lat)
    agg = (log.where(F.col("status") == "ok")
              .groupBy(w.start.alias("window_start"))
              .agg(*[c.alias(f"c{i}") for i, c in enumerate(cums)]))
    pairs = F.array(*[F.struct(F.lit(LE_LABELS[i]).alias("le"), F.col(f"c{i}").alias("cum_count"))
                      for i in range(len(cums))])
    return agg.select("window_start", F.inline(pairs))


def histogram_quantile(q: float, cums: list[Column]) -> Column:
    """Quantile from cumulative bucket counts by linear interpolation inside the
    bucket (first bucket starts at 0); in the overflow bucket the largest finite
    bound is returned; NaN when there are no observations."""
    bounds = S.LATENCY_BUCKETS
    n = cums[-1]
    rank = F.lit(q) * n
    out = F.lit(bounds[-1])  # overflow
    for i in range(len(bounds) - 1, -1, -1):
        lo = F.lit(0.0) if i == 0 else F.lit(bounds[i - 1])
        prev = F.lit(0).cast("long") if i == 0 else cums[i - 1]
        val = lo + (F.lit(bounds[i]) - lo) * ((rank - prev) / (cums[i] - prev))
        out = F.when(cums[i] >= rank, val).otherwise(out)
    return F.when(n == 0, F.lit(float("nan"))).otherwise(out)


def latency_quantiles(log: DataFrame, width: str = "2 minutes", slide: str = "1 minute",
                      limit_s: float = 0.25) -> DataFrame:
    """MON-4: p50 and p95 latency (seconds) per sliding window from the
    histogram, and the alert condition p95 > limit."""
    cums = _cum_counts(F.col("latency_ms") / F.lit(1000.0))
    agg = sliding(log.where(F.col("status") == "ok"), {f"c{i}": c for i, c in enumerate(cums)}, width, slide)
    cc = [F.col(f"c{i}") for i in range(len(cums))]
    return agg.select("window_start", F.col(f"c{len(cums) - 1}").alias("n"),
                      histogram_quantile(0.5, cc).alias("p50_s"), histogram_quantile(0.95, cc).alias("p95_s")) \
              .withColumn("alert", F.col("p95_s") > F.lit(limit_s))


def missing_feature_rates(log: DataFrame, width: str = "1 minute") -> DataFrame:
    """MON-5: missing-feature counts and per-second rates by feature per window."""
    w = F.window("ts", width)
    return (log.select("ts", F.explode("missing_features").alias("feature"))
               .groupBy(w.start.alias("window_start"), "feature")
               .agg(F.count(F.lit(1)).alias("n"))
               .withColumn("rate_per_s", F.col("n") / F.lit(float(_seconds(width)))))


def missing_feature_alert(log: DataFrame, width: str = "2 minutes", slide: str = "1 minute",
                          limit_per_s: float = 1.0) -> DataFrame:
    """MON-5 alert: total missing features per sliding window, rate > limit."""
    agg = sliding(log, {"n_missing": F.sum(F.coalesce(F.size("missing_features"), F.lit(0)))}, width, slide)
    return (agg.withColumn("rate_per_s", F.col("n_missing") / F.lit(float(_seconds(width))))
               .withColumn("alert", F.col("rate_per_s") > F.lit(limit_per_s)))


def with_firing(df: DataFrame, time_col: str = "window_start", flag_col: str = "alert",
                held_minutes: int = 2) -> DataFrame:
    """Adds ``firing`` to per-minute alert rows (MON-7): an alert with ``for: <held_minutes>m``, evaluated once a minute, fires
    when its condition was true now and at each of the ``held_minutes`` evaluations before (a minute without a row has a false one).

    Each true row counts for itself and the next ``held_minutes`` minutes; a minute that counts them all fires."""
    on = F.coalesce(F.col(flag_col), F.lit(False))
    ahead = F.explode(F.sequence(F.lit(0), F.when(on, held_minutes).otherwise(0))).alias("_k")
    spread = df.select(F.struct(*df.columns).alias("_row"), on.alias("_on"), ahead)
    at = F.col(f"_row.{time_col}") + F.make_dt_interval(mins=F.col("_k"))
    met = spread.groupBy(at.alias("_at")).agg(F.first(F.when(F.col("_k") == 0, F.col("_row")), ignorenulls=True).alias("_row"),
                                              F.sum(F.col("_on").cast("int")).alias("_held"))
    return met.where(F.col("_row").isNotNull()).select("_row.*", (F.col("_held") == held_minutes + 1).alias("firing"))


def idle_gaps(log: DataFrame, idle_minutes: int = 5, hold_minutes: int = 10) -> DataFrame:
    """MON-6 + MON-7: one row per time without predictions: first_idle and last_idle (minutes that have none in their last
    ``idle_minutes``), idle_minutes, and where that held for ``hold_minutes``, firing_from and firing_minutes (else null and 0).

    A gap lies between one minute with predictions and the next, however far; the log's ends (its first and last minute with any
    row) bound the first and the last gap.  The next minute is found within its day; the days' first and last ones make one
    array, one entry a day, whose neighbours are the gaps across days."""
    kind = log.schema["ts"].dataType
    minute = F.date_trunc("minute", F.col("ts")).cast(kind)
    per = log.where(F.col("ts").isNotNull()).groupBy(minute.alias("minute")).agg(F.max(F.col("decision").isNotNull()).alias("seen"))
    per = per.withColumn("day", F.to_date("minute"))
    nxt = F.lead("minute").over(Window.partitionBy("day").orderBy("minute"))
    inside = per.where("seen").select(F.col("minute").alias("a"), nxt.alias("b"))
    seen = F.when(F.col("seen"), F.col("minute"))
    days = per.groupBy("day").agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"), F.min(seen).alias("first"), F.max(seen).alias("last"))
    one = days.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "last")))).alias("d")).where("lo is not null")
    step = F.expr("INTERVAL 1 MINUTE")
    ends = F.concat(F.array((F.col("lo") - step).cast(kind)), F.col("d.last")).alias("a")
    starts = F.concat(F.col("d.first"), F.array((F.col("hi") + step).cast(kind))).alias("b")
    across = one.select(F.inline(F.arrays_zip(ends, starts)).alias("a", "b"))
    gap = F.timestamp_diff("MINUTE", F.col("a"), F.col("b"))

    def after(minutes):
        return (F.col("a") + F.make_dt_interval(mins=F.lit(minutes))).cast(kind)

    held = gap - idle_minutes - hold_minutes
    return inside.unionByName(across).where(gap > idle_minutes).select(
        after(idle_minutes).alias("first_idle"), (F.col("b") - step).cast(kind).alias("last_idle"), (gap - idle_minutes).alias("idle_minutes"),
        F.when(held > 0, after(idle_minutes + hold_minutes)).alias("firing_from"), F.greatest(held, F.lit(0)).cast("long").alias("firing_minutes"))


def idle_alert(log: DataFrame, idle_minutes: int = 5, hold_minutes: int = 10) -> DataFrame:
    """MON-6 + MON-7: every minute from the log's first to its last: predictions n, those of the last ``idle_minutes`` (n_last), idle
    (a full span without any) and firing (idle now and at each of the ``hold_minutes`` minutes before).

    Each minute's count is added to itself and the minutes after it that look back on it, so no window runs over the minutes;
    they are made day by day, spread by day."""
    kind = log.schema["ts"].dataType
    minute = F.date_trunc("minute", F.col("ts")).cast(kind)
    per = log.where(F.col("ts").isNotNull()).groupBy(minute.alias("minute")).agg(F.count("decision").alias("n"))
    look = idle_minutes + hold_minutes
    ahead = per.where("n > 0").select("minute", "n", F.explode(F.sequence(F.lit(0), F.lit(look - 1))).alias("_k"))
    at = (F.col("minute") + F.make_dt_interval(mins=F.col("_k"))).cast(kind)
    sums = ahead.groupBy(at.alias("minute")).agg(*[F.sum(F.when(F.col("_k") < k, F.col("n")).otherwise(0)).alias(c)
                                                   for c, k in (("_n", 1), ("_last", idle_minutes), ("_held", look))])
    days = per.agg(F.min("minute").alias("_lo"), F.max("minute").alias("_hi")).select(
        "_lo", "_hi", F.explode(F.sequence(F.to_date("_lo"), F.to_date("_hi"))).alias("_day")).repartition("_day")
    start, step = F.col("_day").cast(kind), F.expr("INTERVAL 1 MINUTE")
    every = days.select("_lo", "_hi", F.explode(F.sequence(start, (start + F.expr("INTERVAL 1439 MINUTE")).cast(kind), step)).alias("minute"))
    every = every.where(F.col("minute").between(F.col("_lo"), F.col("_hi"))).join(sums, "minute", "left").na.fill(0, ["_n", "_last", "_held"])
    age = F.timestamp_diff("MINUTE", F.col("_lo"), F.col("minute")) + 1
    return every.select("minute", F.col("_n").alias("n"), F.col("_last").alias("n_last"), ((F.col("_last") == 0) & (age >= idle_minutes)).alias("idle"),
                        ((F.col("_held") == 0) & (age >= look)).alias("firing"))


def idle_episodes(log: DataFrame, idle_minutes: int = 5, hold_minutes: int = 10) -> DataFrame:
    """MON-7: first and last minute, and number of minutes, of every time that the idle alert fires."""
    fired = idle_gaps(log, idle_minutes, hold_minutes).where("firing_minutes > 0")
    return fired.select(F.col("firing_from").alias("first_minute"), F.col("last_idle").alias("last_minute"), F.col("firing_minutes").alias("minutes"))


def missing_event_ids(requests: DataFrame, width: str = "1 minute") -> DataFrame:
    """MON-8: requests whose event id had to be generated, per window."""
    w = F.window("ts", width)
    return (requests.groupBy(w.start.alias("window_start"))
                    .agg(F.sum(F.col("event_id_missing").cast("int")).cast("long").alias("n_missing"),
                         F.count(F.lit(1)).alias("n")))
