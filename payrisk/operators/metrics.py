"""Binary-classification metrics as DataFrame aggregates (AGG-5..10, WIN-4).

All metrics of one input come out of one ``agg`` where possible.  Average
precision needs a descending running sum over distinct scores, which
:func:`payrisk.operators.quantiles.running_sums` gives range by range, so no
window ever runs unpartitioned over row-level data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.operators.quantiles import running_sums

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def confusion_columns(label, pred) -> dict[str, Column]:
    """AGG-6: tn, fp, fn, tp as conditional sums (order non_fraud, fraud)."""
    y, p = _c(label), _c(pred)
    return {
        "tn": F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("long"),
        "fp": F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("long"),
        "fn": F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("long"),
        "tp": F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("long"),
    }


def safe_ratio(num: Column, den: Column) -> Column:
    """AGG-7: num / den, 0 when den = 0 (``zero_division=0``)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_summary(df: DataFrame, label: str = "is_fraud", prob: str = "fraud_probability",
                           threshold: float = 0.5) -> DataFrame:
    """One row: n, tn, fp, fn, tp, precision, recall, n_classes (AGG-6/7/9)."""
    pred = (F.col(prob) >= F.lit(threshold)).cast("int")
    cm = confusion_columns(label, pred)
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in cm.items()],
                 F.min(label).alias("_ymin"), F.max(label).alias("_ymax"))
    return agg.select(
        "n", "tn", "fp", "fn", "tp",
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.when(F.col("_ymin") != F.col("_ymax"), 2).when(F.col("_ymin").isNotNull(), 1).otherwise(0)
         .alias("n_classes"),
    )


def average_precision(df: DataFrame, label: str = "is_fraud", score: str = "fraud_probability") -> DataFrame:
    """AGG-8: one row ``pr_auc`` = Σ over distinct scores (desc) of
    (ΔRecall × Precision) = Σ tp_s · cum_tp/cum_n ÷ Σ tp.  NaN when the labels
    hold a single class (AGG-9).  One path for every size: see :mod:`payrisk.operators.quantiles`."""
    s = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(F.col(score).cast("double").alias("_s"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("tp")))
    j = running_sums(s.withColumn("g", F.lit(0)), "g", "_s", ["n", "tp"], descending=True)
    agg = j.agg(F.sum(F.col("tp") * F.col("cum_tp") / F.col("cum_n")).alias("_num"),
                F.sum("tp").alias("_pos"), F.sum("n").alias("_all"))
    return agg.select(
        F.when((F.col("_pos") > 0) & (F.col("_pos") < F.col("_all")), F.col("_num") / F.col("_pos"))
         .otherwise(F.lit(float("nan"))).alias("pr_auc"))


def class_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """AGG-10: neg, pos and ``scale_pos_weight = neg / max(pos, 1)``."""
    agg = df.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("long").alias("neg"))
    return agg.select("neg", "pos", (F.col("neg") / F.greatest(F.col("pos"), F.lit(1))).alias("scale_pos_weight"))
