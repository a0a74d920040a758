"""Scoring: heuristic fallback model, trained-model scoring, decisions and
missing-feature flags (ML-3, ML-4, ML-7, ML-8, PRJ-6, PRJ-15, PRJ-18).

The heuristic is a pure column expression; a trained Spark ML
``PipelineModel`` is applied with ``transform`` and P(class 1) is read from
the probability vector with ``vector_to_array`` — no Python UDF either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.functions.columns import decision, heuristic_probability, missing_feature_flags

FALLBACK_VERSION = "fallback"


def with_missing_flags(df: DataFrame, features=tuple(S.ONLINE_FEATURES)) -> DataFrame:
    """ML-8 then PRJ-6: record which features are null, then default them to 0
    (counts) / 0.0 (amounts)."""
    out = df.withColumn("missing_features", missing_feature_flags(features))
    for f in features:
        zero = F.lit(0).cast("long") if f.startswith("txn_count") else F.lit(0.0)
        out = out.withColumn(f, F.coalesce(F.col(f).cast("long" if f.startswith("txn_count") else "double"), zero))
    return out


def fill_event_id(df: DataFrame, event_id: str = "event_id", basis: list[str] | None = None,
                  number_equal: bool = False) -> DataFrame:
    """PRJ-18: a missing/empty event id is replaced by a deterministic id (sha2 of
    the row's other fields), so a retried batch gets the same id; flag kept in
    ``event_id_missing``.  With ``number_equal``, rows equal in all these fields get an id each
    (numbered among themselves; rows with an id are neither moved nor sorted, so ``df`` is read twice)."""
    basis = basis or [c for c in df.columns if c != event_id]
    raw = F.to_json(F.struct(*[F.col(c) for c in basis]))
    missing = F.col(event_id).isNull() | (F.col(event_id) == "")
    if number_equal:
        nth = F.row_number().over(Window.partitionBy(raw).orderBy(F.lit(0)))
        df = df.where(missing).withColumn("_nth", nth).unionByName(df.where(~missing).withColumn("_nth", F.lit(1)))
        raw = F.when(F.col("_nth") == 1, raw).otherwise(F.concat(raw, F.lit("#"), F.col("_nth")))
        return fill_with(df, event_id, missing, raw).drop("_nth")
    return fill_with(df, event_id, missing, raw)


def fill_with(df: DataFrame, event_id: str, missing: Column, raw: Column) -> DataFrame:
    return (df.withColumn("event_id_missing", missing)
              .withColumn(event_id, F.when(missing, F.concat(F.lit("gen-"), F.sha2(raw, 256).substr(1, 32)))
                          .otherwise(F.col(event_id))))


def score_heuristic(df: DataFrame, threshold: float = S.DECISION_THRESHOLD) -> DataFrame:
    """ML-3 + PRJ-15 + ML-7: fallback probability, decision and version tag."""
    return (df.withColumn("fraud_probability", heuristic_probability())
              .withColumn("decision", decision("fraud_probability", threshold))
              .withColumn("model_version", F.lit(FALLBACK_VERSION)))


def score_model(df: DataFrame, model, version: str, threshold: float = S.DECISION_THRESHOLD,
                features: list[str] = S.FEATURE_ORDER) -> DataFrame:
    """ML-4: apply a fitted ``PipelineModel`` whose first stage assembles
    ``features`` into a vector; P(class 1) → ``fraud_probability``."""
    from pyspark.ml.functions import vector_to_array

    cols = df.columns
    scored = model.transform(df.withColumns({f: F.col(f).cast("double") for f in features if f in cols}))
    return (scored.withColumn("fraud_probability", vector_to_array(F.col("probability")).getItem(1))
                  .select(*cols, "fraud_probability")
                  .withColumn("decision", decision("fraud_probability", threshold))
                  .withColumn("model_version", F.lit(version)))


def score(df: DataFrame, model=None, version: str | None = None, threshold: float = S.DECISION_THRESHOLD) -> DataFrame:
    """Score with ``model`` when given, else the heuristic fallback (ML-7)."""
    if model is None:
        return score_heuristic(df, threshold)
    return score_model(df, model, version or "unknown", threshold)


def score_python_model(df: DataFrame, predict_proba, version: str, threshold: float = S.DECISION_THRESHOLD,
                       features: list[str] = S.FEATURE_ORDER) -> DataFrame:
    """ML-4 for a foreign Python model (anything with ``predict_proba(X)`` on a
    float matrix in ``features`` order, e.g. a booster trained elsewhere).

    The only Python on a scoring path, and opt-in: rows go to the model in
    Arrow batches through ``mapInPandas`` (one model call per batch, never per
    row); the model object is shipped once with the task closure.  Output:
    the input columns plus fraud_probability, decision, model_version.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    schema = T.StructType(df.schema.fields + [T.StructField("fraud_probability", T.DoubleType(), True)])
    cols = list(df.columns)
    feats = list(features)

    def run(batches):
        for pdf in batches:
            x = pdf[feats].astype("float64").fillna(0.0).to_numpy()
            p = np.asarray(predict_proba(x))[:, 1] if len(pdf) else np.empty(0)
            yield pd.concat([pdf[cols].reset_index(drop=True), pd.Series(p, name="fraud_probability")], axis=1)

    scored = df.mapInPandas(run, schema)
    return (scored.withColumn("decision", decision("fraud_probability", threshold))
                  .withColumn("model_version", F.lit(version)))
