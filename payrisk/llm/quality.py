"""Quality classifier (operator 4): ridge regression on random Fourier features, then isotonic calibration.

Document statistics are standardised; ``cos(Wx + b)`` with Gaussian W approximates a Gaussian kernel over them.  Every
partition sums its part of the normal equations, the sums are added in Spark, and one small solve gives the ridge
weights.  Calibration pools adjacent violators over score bins counted on rows that the ridge did not see.

Cases: null and empty texts have all-zero statistics and are scored; rows repeated or with equal scores are scored alike;
labels that are null or not 0/1 are not learnt from; without labelled rows every score is 0.5; an empty table gives an empty
result; further columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.llm.common import attach, id_hash, land
from payrisk.llm.textstats import FIELDS, RATES, stats

BINS = 512


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names], axis=1)


def features(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of standardised statistics, with a constant."""
    z = np.clip((x - model["mean"]) / model["std"], -6, 6)
    return np.concatenate([np.cos(z @ model["w"] + model["b"]) * np.sqrt(2 / model["w"].shape[1]), np.ones((len(x), 1))], axis=1)


def fit(rows: DataFrame, label: str, n_features: int = 256, width: float = 4.0, ridge: float = 0.3, seed: int = 4) -> dict:
    """Model from ``rows``: the columns RATES, ``label`` (0/1) and ``fold`` (0..9; 7 and above calibrate only)."""
    rows = rows.filter(F.col(label).isin(0, 1))
    agg = rows.agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{k}_{c}") for c in RATES for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if not agg["n"]:
        return {}
    rng = np.random.default_rng(seed)
    model = {"mean": np.array([agg[f"m_{c}"] for c in RATES]), "std": np.array([max(agg[f"s_{c}"], 1e-6) for c in RATES]),
             "w": rng.normal(0, 1 / width, (len(RATES), n_features)), "b": rng.uniform(0, 2 * np.pi, n_features)}
    d = n_features + 1

    def partial(batches):
        total = np.zeros((d, d + 1))
        for b in batches:
            z, y = features(_matrix(b, RATES), model), b.column(b.schema.get_field_index(label)).to_numpy().astype(float)
            total += z.T @ np.concatenate([z, y[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([int(np.abs(total).sum() * 1000) % 16]), pa.array([total.tobytes()])], names=["k", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in group.column("sums"))
        return pa.table({"sums": [total.tobytes()]})

    parts = (rows.filter("fold < 7").select(*RATES, F.col(label)).mapInArrow(partial, "k long, sums binary")
             .groupBy("k").applyInArrow(add, "sums binary").collect())
    total = sum(np.frombuffer(bytes(r["sums"])) for r in parts).reshape(d, d + 1)
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-6
    model["beta"] = np.linalg.solve(total[:, :-1] + np.diag(penalty), total[:, -1])

    def binned(batches):
        for b in batches:
            at = _bin(features(_matrix(b, RATES), model) @ model["beta"])
            yield pa.RecordBatch.from_arrays([pa.array(at), b.column(b.schema.get_field_index(label)).cast(pa.int32())], names=["bin", "y"])

    seen = {r["bin"]: (r["n"], r["pos"]) for r in rows.filter("fold >= 7").select(*RATES, F.col(label)).mapInArrow(binned, "bin long, y int")
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).collect()}
    base = (sum(p for _, p in seen.values()) + 1) / (sum(n for n, _ in seen.values()) + 2)
    model["curve"] = pool(np.array([seen.get(i, (0, 0))[0] for i in range(BINS)], float),
                          np.array([seen.get(i, (0, 0))[1] for i in range(BINS)], float), base)
    return model


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def pool(n: np.ndarray, pos: np.ndarray, base: float) -> np.ndarray:
    """Isotonic regression by pool-adjacent-violators over bins; empty bins lie between their neighbours.

    Half an observation at the base rate in every block keeps rates off 0 and 1.
    """
    blocks: list[list[float]] = []  # weight, positives, first bin, last bin
    for i in np.flatnonzero(n):
        blocks.append([n[i], pos[i], i, i])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            w, p, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + p, blocks[-1][2], last]
    if not blocks:
        return np.full(len(n), base)
    at, rate = [], []
    for w, p, lo, hi in blocks:
        at += [lo, hi]
        rate += [(p + base / 2) / (w + 0.5)] * 2
    return np.maximum.accumulate(np.interp(np.arange(len(n)), at, rate))


def predict(x: np.ndarray, model: dict) -> np.ndarray:
    if not model:
        return np.full(len(x), 0.5)
    return np.clip(model["curve"][_bin(features(x, model) @ model["beta"])], 0.0, 1.0)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """(row, score) for any documents by a fitted model."""
    def run(texts):
        got = stats(texts)
        return {"score": predict(np.stack([got[c] for c in RATES], axis=1), model)}
    return attach(docs, run, [T.StructField("score", T.DoubleType())], text_col)


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and all statistics of every document, landed: texts are read once."""
    got = attach(docs.select("doc_id", "text"), stats, FIELDS)
    return land(got.select(F.col("row.doc_id").alias("doc_id"), *[f.name for f in FIELDS]), "docstats")


def labelled(stats_of: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Statistics joined to one label per document (the largest, if several)."""
    one = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    return stats_of.join(one, "doc_id")


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op4: doc_id, held_out, score, predicted for all documents."""
    all_stats = document_stats(docs).withColumn("held_out", id_hash("doc_id", 5) == 0)
    train = (labelled(all_stats.filter("not held_out"), labels, "quality")
             .withColumn("fold", F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(10))))
    model = fit(train.select(*RATES, "quality", "fold"), "quality")

    def run(batches):
        for b in batches:
            s = predict(_matrix(b, RATES), model)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.3).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return all_stats.select("doc_id", "held_out", *RATES).mapInArrow(
        run, T.StructType([all_stats.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
