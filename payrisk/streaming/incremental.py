"""Feature tables that follow deliveries of payment files (AGG-1, AGG-2): only windows that new rows touch are computed again.

The file source's own log says which files are new; a micro-batch of them names the (card, window) pairs touched, and just these are
computed again from all rows delivered so far, read from the touched days.  Late rows, however late, so correct their windows.  Results are
appended with their creation time, a folder per batch that a batch run again overwrites; the newest creation per card and window counts,
which is the rule of the point-in-time join too (JOIN-1), so that join takes the table as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payrisk.functions.columns import window_end
from payrisk.operators.pit import latest_per_key
from payrisk.operators.velocity import card_velocity_1m, card_velocity_5m

#: view name -> window, aggregation
VIEWS: dict[str, tuple[str, Callable]] = {"1m": ("1 minute", card_velocity_1m), "5m": ("5 minutes", card_velocity_5m)}
MAX_RANGES = 32


def day_ranges(days: list[date], most: int = MAX_RANGES) -> list[tuple[date, date]]:
    """``days`` as ascending half-open ranges; one range over all where there are more than ``most``."""
    out: list[tuple[date, date]] = []
    for d in sorted(days):
        if out and out[-1][1] == d:
            out[-1] = (out[-1][0], d + timedelta(days=1))
        else:
            out.append((d, d + timedelta(days=1)))
    return out if len(out) <= most else [(out[0][0], out[-1][1])]


def within(ts: str, ranges: list[tuple[date, date]]) -> Column:
    """A filter of ``ts`` by ranges of days that reaches the Parquet reader."""
    found = F.lit(False)
    for a, b in ranges:
        found = found | ((F.col(ts) >= F.lit(f"{a} 00:00:00").cast("timestamp_ntz")) & (F.col(ts) < F.lit(f"{b} 00:00:00").cast("timestamp_ntz")))
    return found


def update_views(batch: DataFrame, batch_id: int, history: DataFrame, path: str, views=tuple(VIEWS)) -> None:
    """Computes the windows that ``batch`` touches again from ``history`` (which holds the batch's rows too) and
    writes them to ``<path>/<view>/batch=<id>``.  Rows without card, time or amount touch nothing."""
    new = batch.select("card_id", "event_timestamp", "amount").dropna()
    days = [r[0] for r in new.select(F.to_date("event_timestamp").alias("d")).distinct().collect()]  # a row per calendar day
    if not days:
        return
    rows = history.select("card_id", "event_timestamp", "amount").where(within("event_timestamp", day_ranges(days)))
    for view in views:
        width, aggregate = VIEWS[view]
        touched = new.select("card_id", window_end("event_timestamp", width).alias("event_timestamp")).distinct()
        again = aggregate(rows, F.current_timestamp()).join(touched, ["card_id", "event_timestamp"], "left_semi")
        again.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{view}/batch={batch_id}")


def start_views(spark: SparkSession, payments_path: str, schema: StructType, path: str, checkpoint: str,
                trigger: dict | None = None, views=tuple(VIEWS)):
    """A checkpointed stream over the Parquet files under ``payments_path`` that keeps the views under ``path``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        update_views(batch, batch_id, batch.sparkSession.read.schema(schema).parquet(payments_path), path, views)

    return (spark.readStream.schema(schema).parquet(payments_path).writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """The view's newest row per card and window."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/{view}")
    fields = [c for c in rows.columns if c not in ("card_id", "event_timestamp", "batch")]
    return latest_per_key(rows, ("card_id", "event_timestamp"), "created_timestamp", "batch", fields)
