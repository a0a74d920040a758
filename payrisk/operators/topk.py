"""Newest-N selection and time cutoffs (TOPK-1, TOPK-2, SORT-1, FLT-3, FLT-4, AGG-16).

``tail_by_time`` returns exactly the N newest rows (ties broken by the given
columns, descending) without pulling per-partition top-N lists of size N into
one task: a per-bucket histogram of the time column (one row per bucket)
finds the newest bucket from which N rows are available; rows older than that
bucket are filtered out before the final ``orderBy().limit(N)``, so the final
merge sees at most N + one bucket of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.functions.columns import epoch_seconds


def tail_by_time(df: DataFrame, n: int, ts: str = "ts", tiebreak: tuple[str, ...] = ("event_id",),
                 bucket_seconds: int = 60) -> DataFrame:
    """The ``n`` rows with the greatest (``ts``, *tiebreak*), as a DataFrame.

    Rows with a null ``ts`` sort last (never picked while non-null ones remain).
    The pre-filter is ``ts >= <first time of the oldest bucket still needed>``,
    a scalar subquery compared directly with the column, so Spark pushes it
    into the Parquet reader at run time and skips older row groups.
    """
    if n <= 0:
        return df.limit(0)
    b = F.floor(epoch_seconds(ts) / F.lit(bucket_seconds))
    hist = (df.where(F.col(ts).isNotNull()).groupBy(b.alias("_b"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first")))
    # cumulative rows from the newest bucket downwards; one row per bucket (small)
    cum = hist.withColumn("_cum", F.sum("_n").over(
        Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    oldest = F.lit("0001-01-01 00:00:00").cast(df.schema[ts].dataType)
    start = cum.where(F.col("_cum") >= F.lit(n)).agg(F.coalesce(F.max_by("_first", "_b"), oldest)).scalar()
    keep = df.where((F.col(ts) >= start) | F.col(ts).isNull())
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    return keep.orderBy(*order).limit(n)


def before_cutoff(df: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    """FLT-3 / FLT-4: rows with ``ts <= cutoff``.  With ``cutoff`` from
    :func:`max_minus` the comparison is column-vs-subquery, which Spark pushes
    into the Parquet reader at run time."""
    return df.where(F.col(ts) <= cutoff)


def max_minus(df: DataFrame, col: str, minutes: int) -> Column:
    """``max(col) − minutes`` computed inside one scalar subquery."""
    return df.agg(F.timestamp_add("MINUTE", F.lit(-int(minutes)), F.max(col))).scalar()
