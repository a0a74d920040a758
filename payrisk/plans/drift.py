"""Drift report (AGG-13): PSI of amount and of the two 1-minute features
between the offline data (expected) and the recent prediction log (actual)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.operators.psi import inner_edges_of, psi_of_columns
from payrisk.operators.quantiles import flat_values
from payrisk.session import scratch_path


def drift_report(payments: DataFrame, features_1m: DataFrame, recent_log: DataFrame,
                 bins: int = S.PSI_BINS, eps: float = S.PSI_EPS) -> DataFrame:
    """Long form: one row per feature (psi_amount, psi_txn_count_1m,
    psi_amount_sum_1m) with psi, n_bins, n_expected, n_actual, n_recent.

    The two feature columns are landed once, as they come from an aggregation; amounts are scanned as they are.  The edges
    of all three come from two scans of the expected side, the bins of both sides from one grouped pass, in which the log's
    rows are counted too."""
    spark, cols = payments.sparkSession, ["amount", "txn_count_1m", "amount_sum_1m"]
    path = scratch_path(spark, "drift-features")
    features_1m.select(*cols[1:]).write.parquet(path)
    expected = flat_values(payments, cols[:1]).unionByName(flat_values(spark.read.parquet(path), cols[1:]))
    edges = inner_edges_of(expected, bins)
    log = recent_log.select(*cols, F.lit(0.0).alias("n_recent"))  # a value in every row, so its count is the rows'
    sides = (expected.withColumn("expected", F.lit(True))
             .unionByName(flat_values(log, [*cols, "n_recent"]).withColumn("expected", F.lit(False))))
    found = psi_of_columns(sides, {**{c: edges.get(c, []) for c in cols}, "n_recent": []}, eps)
    rows = F.max(F.when(F.col("feature") == "n_recent", F.col("n_actual"))).over(Window.partitionBy(F.lit(0)))  # four rows
    return (found.withColumn("n_recent", rows).where(F.col("feature") != "n_recent")
            .select(F.concat(F.lit("psi_"), "feature").alias("feature"), "psi",
                    F.when(F.col("n_expected") > 0, F.col("n_bins")).otherwise(0).cast("int").alias("n_bins"),
                    "n_expected", F.when(F.col("n_expected") > 0, F.col("n_actual")).otherwise(0).alias("n_actual"), "n_recent"))
