"""Toxicity (operator 10): a factorization machine over hashed terms.

A text's terms are its distinct lower-case words and, of longer ones, their first 4, 5 and 6 letters, hashed to 2^24 places.  The machine
learns a weight and a small factor vector per informative term (the 1,024 of largest log-likelihood ratio, at least 6, that three texts have):
factors add a score for pairs, so an insult beside a group's name counts more than the two apart, which no additive weights can say.

Cases: null and empty texts have no term and get the bias alone; very long texts are read whole, in parts of bounded size; other columns,
whatever their names, take no part; repeated rows and ties are scored alike, and learnt from once; labels that are null
or not 0/1 are not learnt from; without labelled rows of both classes every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.llm.common import attach, codes, distinct, id_hash, land, runs, slices, word_hashes
from payrisk.llm.langid import _tables

SPACE = 1 << 24
PREFIXES = (4, 5, 6)


def terms(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs, sorted."""
    lower, letter = _tables()
    c, first = codes(texts)
    c = np.minimum(c, np.uint32(len(lower) - 1))
    known = letter[c]
    low = np.where(known, lower[c], 0).astype(np.uint32)
    starts, ends = runs(known)
    of = np.searchsorted(first, starts, side="right") - 1
    whole = word_hashes(low, starts, ends) % np.uint64(SPACE)
    keys = [of.astype(np.uint64) * np.uint64(SPACE) + whole]
    for k in PREFIXES:
        long = ends - starts > k
        head = (word_hashes(low, starts[long], starts[long] + k) ^ np.uint64(0x5BD1)) % np.uint64(SPACE)
        keys.append(of[long].astype(np.uint64) * np.uint64(SPACE) + head)
    key = distinct(np.concatenate(keys))
    return (key // np.uint64(SPACE)).astype(np.int64), (key % np.uint64(SPACE)).astype(np.int64)


def _margin(of: np.ndarray, col: np.ndarray, n: int, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores of n texts from their (text, column) pairs, and the factor sums per text."""
    k = model["v"].shape[1]
    s, q = np.zeros((n, k)), np.zeros(n)
    out = np.full(n, model["b"]) + np.bincount(of, weights=model["w"][col], minlength=n)
    v = model["v"][col]
    for f in range(k):
        s[:, f] = np.bincount(of, weights=v[:, f], minlength=n)
    q = np.bincount(of, weights=(v * v).sum(axis=1), minlength=n)
    return out + 0.5 * ((s * s).sum(axis=1) - q), s


def train(of: np.ndarray, col: np.ndarray, y: np.ndarray, terms_of: np.ndarray, factors: int = 4, rounds: int = 400,
          l1: float = 1e-4, decay: float = 0.03, rate: float = 0.05, balance: float = 4.0, seed: int = 10) -> dict:
    """Machine over the (text, column) pairs by Adam on logistic loss; ``terms_of`` has the term of each column, sorted.

    Weights shrink towards 0 by ``l1`` (few terms stay); factors shrink by the share ``decay`` of each step's rate, apart from their
    gradient, so that terms which never matter in pairs lose theirs and the others keep them.
    Toxic rows weigh ``balance`` times as much.
    """
    n, pos, k = len(y), y.sum(), len(terms_of)
    if not k or not pos or pos == n:
        return {"terms": np.zeros(0, np.int64), "w": np.zeros(0), "v": np.zeros((0, factors)), "b": -50.0}
    rng = np.random.default_rng(seed)
    model = {"terms": terms_of, "w": np.zeros(k), "v": rng.normal(0, 0.1, (k, factors)), "b": float(np.log(pos / (n - pos)))}
    m = {x: np.zeros_like(np.asarray(model[x], float)) for x in ("w", "v", "b")}
    u = {x: np.zeros_like(np.asarray(model[x], float)) for x in ("w", "v", "b")}
    for t in range(1, rounds + 1):
        raw, s = _margin(of, col, n, model)
        g = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y) * np.where(y > 0, balance, 1.0) / n
        gc = g[of]
        gv = np.stack([np.bincount(col, weights=gc * (s[of, f] - model["v"][col, f]), minlength=k) for f in range(factors)], axis=1)
        grads = {"w": np.bincount(col, weights=gc, minlength=k), "v": gv, "b": g.sum()}
        for x, d in grads.items():
            m[x] = 0.9 * m[x] + 0.1 * d
            u[x] = 0.99 * u[x] + 0.01 * d * d
            step = rate / (np.sqrt(u[x] / (1 - 0.99**t)) + 1e-6)
            model[x] = model[x] - step * (m[x] / (1 - 0.9**t))
            if x == "w":
                model[x] = np.sign(model[x]) * np.maximum(np.abs(model[x]) - step * l1, 0)
            elif x == "v":
                model[x] = model[x] * (1 - rate * decay)
    model["b"] = float(model["b"])
    return model


def _columns(texts: list, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, column) pairs of the chosen terms."""
    of, term = terms(texts)
    if not len(chosen):
        return of[:0], term[:0]
    at = np.minimum(np.searchsorted(chosen, term), len(chosen) - 1)
    on = chosen[at] == term
    return of[on], at[on]


def probabilities(texts: list, model: dict) -> np.ndarray:
    raw, _ = _margin(*_columns(texts, model["terms"]), len(texts), model)
    return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def informative(counts: DataFrame, n: int, pos: int, columns: int, least_gain: float) -> np.ndarray:
    """The ``columns`` terms of ``counts(term, n, pos)`` with the largest log-likelihood ratio, at least ``least_gain``, sorted."""
    a, d = F.col("pos").cast("double"), F.col("n").cast("double")

    def part(x, share):  # x * log(x / expected)
        return F.when(x > 0, x * F.log(x / share)).otherwise(F.lit(0.0))

    gain = (part(a, d * pos / n) + part(d - a, d * (n - pos) / n) + part(pos - a, (n - d) * pos / n)
            + part(n - d - pos + a, (n - d) * (n - pos) / n))
    best = counts.filter("n >= 3").withColumn("gain", gain).filter(F.col("gain") >= least_gain).orderBy(F.desc("gain"), "term").limit(columns)
    return np.array(sorted(r["term"] for r in best.select("term").collect()), np.int64)


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 20_000, columns: int = 1024, least_gain: float = 6.0) -> dict:
    """Machine from at most about ``max_rows`` labelled rows (documented bound; those with the least hashes of id, then of id and text).

    Terms are counted and chosen in Spark; the driver gets the chosen terms of the sample's rows.  The broadcast side is the
    sample's ids, bounded by ``max_rows``.
    """
    one = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n = one.count()
    if n > max_rows:
        one = one.filter(F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(one), "doc_id").select("doc_id", "text", "y")
    rows = rows.dropDuplicates(["doc_id", "text"])
    if (held := rows.count()) > 1.25 * max_rows:  # one id may have any number of rows
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * max_rows / held))
    rows = land(rows, "toxic-rows")

    def count(batches):
        for b in batches:
            texts, y = b.column(1).to_pylist(), b.column(2).to_numpy()
            for lo, hi in slices(texts):
                of, term = terms(texts[lo:hi])
                of, term = np.concatenate([of, np.arange(hi - lo)]), np.concatenate([term, np.full(hi - lo, -1)])  # -1: every text
                places, at = np.unique(term, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.bincount(at)), pa.array(np.bincount(at, weights=y[lo:hi][of]).astype(np.int64))],
                                                 names=["term", "n", "pos"])

    counts = land(rows.mapInArrow(count, "term long, n long, pos long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).filter("n >= 3 or term = -1"), "terms")
    total = counts.filter("term = -1").first()
    if total is None:
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    chosen = informative(counts.filter("term >= 0"), total["n"], total["pos"], columns, least_gain)

    def pick(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                of, col = _columns(texts[lo:hi], chosen)
                cut = np.searchsorted(of, np.arange(hi - lo + 1))
                blobs = [col[cut[i] : cut[i + 1]].astype("<i4").tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(blobs, pa.binary()), b.column(2).slice(lo, hi - lo)],
                                                 names=["doc_id", "cols", "y"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("cols", T.BinaryType()), T.StructField("y", T.IntegerType())])
    got = sorted(rows.mapInArrow(pick, schema).collect(), key=lambda r: (r["doc_id"], bytes(r["cols"])))
    lists = [np.frombuffer(bytes(r["cols"]), "<i4").astype(np.int64) for r in got]
    of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return train(of, np.concatenate([*lists, np.zeros(0, np.int64)]), np.array([float(r["y"]) for r in got]), chosen)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """(row, score): probability of toxicity of every whole text."""
    return attach(docs, lambda texts: {"score": probabilities(texts, model)}, [T.StructField("score", T.DoubleType())], text_col)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows the contract lets us learn from: crc32(doc_id as text) mod 3 is not 1."""
    return docs.filter(id_hash("doc_id", 3) != 1)


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op10: doc_id, held_out, score, predicted for all documents."""
    model = learn(learnable(docs), learnable(labels))
    return score(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), (id_hash("row.doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def toxicity_stage(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pipeline: documents scored at or above the threshold go."""
    return score(docs, learn(learnable(docs), learnable(labels))).filter(F.col("score") < threshold).select("row.*")
