"""Model training (ML-1, ML-2, ML-5, ML-6, AGG-10, SNK-8).

Training frame: labelled payments → join time aligned to the 5-minute window
end → point-in-time join of both feature views → missing features 0 →
feature vector in the fixed order.  Split: deterministic stratified 80/20.
Positive rows are weighted by neg/pos of the training split.  ``booster`` names the model:
``hist`` is :mod:`payrisk.operators.boosting` (second order, L2 on leaves, Hessian child weight: every parameter
of the reference's booster has its own meaning); ``gbt`` is the first-order form there, which fits the trees of Spark ML's
``GBTClassifier`` (log loss, variance impurity) on blocks of rows; ``ml`` is that estimator itself, with trees → maxIter, depth →
maxDepth, learning rate → stepSize, row subsample → subsamplingRate, column subsample →
featureSubsetStrategy, histogram bins → maxBins, min-child-weight → minInstancesPerNode.  Both count
rows instead of their weight and have no L2.  Scores will not equal the reference's booster (other row and column draws).
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.functions.columns import window_end
from payrisk.operators.boosting import BoostedTrees, fit_boosted
from payrisk.operators.metrics import average_precision, class_weight, classification_summary
from payrisk.operators.pit import point_in_time_join
from payrisk.operators.score import score_model
from payrisk.operators.split import stratified_split
from payrisk.plans.features import velocity_views
from payrisk.session import checkpoint_root

FILL = {"txn_count_1m": 0, "amount_sum_1m": 0.0, "txn_count_5m": 0, "avg_transaction_amount_5m": 0.0}


@dataclass(frozen=True)
class TrainParams:
    """Reference defaults."""

    test_size: float = 0.2
    seed: int = 42
    n_estimators: int = 300
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.9
    colsample_bytree: float = 0.9
    max_bins: int = 256
    min_child_weight: float = 1.0
    threshold: float = S.DECISION_THRESHOLD
    reg_lambda: float = 1.0
    booster: str = "gbt"


def training_frame(payments: DataFrame) -> DataFrame:
    """ML-1: event_id, card_id, event_timestamp (5-minute window end), amount,
    is_fraud and the four features (missing → 0)."""
    p = payments.dropna(subset=["card_id", "event_timestamp", "amount", "is_fraud"])
    ent = p.select("event_id", "card_id", window_end("event_timestamp", "5 minutes").alias("event_timestamp"),
                   F.col("amount").cast("double").alias("amount"), F.col("is_fraud").cast("int").alias("is_fraud"))
    return point_in_time_join(ent, velocity_views(p), fill=FILL)


def weighted(train_df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """AGG-10: weight = neg/max(pos,1) for positives, 1 for negatives (scalar subquery, no collect)."""
    spw = class_weight(train_df, label).select("scale_pos_weight").scalar()
    return train_df.withColumn("weight", F.when(F.col(label) == 1, spw).otherwise(F.lit(1.0)))


def build_estimator(params: TrainParams) -> Pipeline:
    """ML-2 + PRJ-14: vector assembly in the fixed feature order, then GBT."""
    gbt = GBTClassifier(labelCol="is_fraud", featuresCol="features", weightCol="weight", lossType="logistic",
                        maxIter=params.n_estimators, maxDepth=params.max_depth, stepSize=params.learning_rate,
                        subsamplingRate=params.subsample, featureSubsetStrategy=str(params.colsample_bytree),
                        maxBins=params.max_bins, seed=params.seed,
                        minInstancesPerNode=max(1, round(params.min_child_weight)))
    return Pipeline(stages=[VectorAssembler(inputCols=S.FEATURE_ORDER, outputCol="features"), gbt])


def fit(train_df: DataFrame, params: TrainParams) -> PipelineModel | BoostedTrees:
    """ML-2: the model that ``params.booster`` names, fitted on the weighted training split."""
    if params.booster == "ml":
        return build_estimator(params).fit(train_df)
    if params.booster not in ("gbt", "hist"):
        raise ValueError(f"unknown booster {params.booster}")
    return fit_boosted(train_df, S.FEATURE_ORDER, "is_fraud", "weight", n_estimators=params.n_estimators, max_depth=params.max_depth,
                       learning_rate=params.learning_rate, reg_lambda=params.reg_lambda, min_child_weight=params.min_child_weight,
                       max_bins=params.max_bins, subsample=params.subsample, colsample=params.colsample_bytree,
                       row_key="event_id", seed=params.seed, first_order=params.booster == "gbt",
                       min_child_rows=max(1, round(params.min_child_weight)))


def train(payments: DataFrame, params: TrainParams = TrainParams()) -> tuple[PipelineModel | BoostedTrees, DataFrame]:
    """Fit on the training split, evaluate on the test split (ML-5).

    The weighted training split is checkpointed to the shared folder before
    the iterative fit (it is read once per boosting round).  Returns the
    model and a one-row metrics frame: n_train, n_test, scale_pos_weight,
    pr_auc, precision, recall, tn, fp, fn, tp.
    """
    frame = stratified_split(training_frame(payments), "is_fraud", "event_id", params.test_size, params.seed)
    checkpoint_root(frame.sparkSession)
    frame = frame.checkpoint(eager=True)
    train_df = weighted(frame.where(~F.col("is_test")))
    test_df = frame.where(F.col("is_test"))
    model = fit(train_df, params)
    scored = score_model(test_df, model, "candidate", params.threshold)
    summ = classification_summary(scored, "is_fraud", "fraud_probability", params.threshold)
    ap = average_precision(scored, "is_fraud", "fraud_probability").scalar()
    spw = class_weight(frame.where(~F.col("is_test"))).select("scale_pos_weight").scalar()
    n_train = frame.where(~F.col("is_test")).agg(F.count(F.lit(1))).scalar()
    metrics = summ.select(n_train.alias("n_train"), F.col("n").alias("n_test"), spw.alias("scale_pos_weight"),
                          ap.alias("pr_auc"), "precision", "recall", "tn", "fp", "fn", "tp")
    return model, metrics


def save_model(model: PipelineModel | BoostedTrees, path: str) -> str:
    """ML-6: persist (overwrite)."""
    if isinstance(model, BoostedTrees):
        return model.save(path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | BoostedTrees:
    """ML-6: reload."""
    return BoostedTrees.load(path) if _there(f"{path}/trees") else PipelineModel.load(path)


def load_model_or_fallback(path: str | None, allow_fallback: bool = True):
    """ML-7: the saved model and its version tag, or ``(None, 'fallback')``
    when no model lies at ``path`` and ``allow_fallback`` is on (scoring then uses
    the heuristic).  A model that is there but cannot be read is an error."""
    if path and _there(path):
        return load_model(path), path.rstrip("/").rsplit("/", 1)[-1]
    if not allow_fallback:
        raise FileNotFoundError(f"no model at {path}")
    return None, "fallback"


def _there(path: str) -> bool:
    spark = SparkSession.active()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def log_run(metrics: DataFrame, runs_path: str, run_name: str, params: dict) -> DataFrame:
    """SNK-8: append one row (run_id, run_name, params map, metrics map,
    logged_at) to the runs table; the metrics map is built from the metrics
    frame's numeric columns without a driver round trip."""
    num = [c for c, t in metrics.dtypes if t in ("double", "bigint", "int", "float")]
    mm = F.create_map(*[x for c in num for x in (F.lit(c), F.col(c).cast("double"))])
    pm = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))])
    row = metrics.select(F.lit(uuid.uuid4().hex).alias("run_id"), F.lit(run_name).alias("run_name"),
                         pm.alias("params"), mm.alias("metrics"), F.current_timestamp().alias("logged_at"))
    row.write.mode("append").parquet(runs_path)
    return row


__all__ = ["TrainParams", "training_frame", "weighted", "build_estimator", "fit", "train", "save_model", "load_model",
           "log_run", "asdict"]
