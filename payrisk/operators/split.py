"""Deterministic stratified train/test split (WIN-5).

Within each class, rows are ordered by ``md5(seed ‖ ':' ‖ id)`` (then id);
the first ``round(n_class × test_size)`` are the test set.  The order is a
property of each row, so the split does not change with partitioning or
re-runs (unlike ``randomSplit``).

The per-class rank is computed in two levels, because a single window per
class would put the majority class (almost every row) into one task: rows
are grouped by (class, first hex digits of the hash) — a prefix of the sort
key, so group order is sort order — group sizes are prefix-summed over the
group table (at most 2·16^k rows, broadcast by that bound), and a
partitioned ``row_number`` inside each group finishes the rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratified_split(df: DataFrame, label: str = "is_fraud", id_col: str = "event_id", test_size: float = 0.2,
                     seed: int = 42, prefix_hex: int = 4, out: str = "is_test") -> DataFrame:
    """Add boolean ``out``: True for the test rows."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    x = df.withColumn("_h", h).withColumn("_g", F.conv(F.substring("_h", 1, prefix_hex), 16, 10).cast("long"))
    groups = x.groupBy(label, "_g").agg(F.count(F.lit(1)).alias("_gn"))
    by_class = Window.partitionBy(label)
    before = Window.partitionBy(label).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    groups = (groups.withColumn("_off", F.coalesce(F.sum("_gn").over(before), F.lit(0)))
                    .withColumn("_ncls", F.sum("_gn").over(by_class))
                    .withColumn("_ntest", F.round(F.col("_ncls") * F.lit(float(test_size))).cast("long"))
                    .drop("_gn"))
    # groups has at most (#classes × 16^prefix_hex) rows
    j = x.join(F.broadcast(groups), [label, "_g"])
    rn = F.row_number().over(Window.partitionBy(label, "_g").orderBy("_h", id_col))
    return (j.withColumn(out, (F.col("_off") + rn) <= F.col("_ntest"))
             .drop("_h", "_g", "_off", "_ncls", "_ntest"))
