import numpy as np
from pyspark.sql import functions as F

from payrisk.llm import toxicity


def test_pairs_that_no_additive_weights_tell_apart():
    """Toxic only if both terms occur: w1 + w2 + interaction."""
    rng = np.random.default_rng(0)
    x = rng.random((2000, 6)) < 0.5
    y = (x[:, 0] & x[:, 1]).astype(float)
    of, col = np.nonzero(x)
    model = toxicity.train(of, col, y, np.arange(6), balance=1.0)
    raw, _ = toxicity._margin(of, col, 2000, model)
    assert ((raw > 0) == (y > 0)).mean() > 0.98
    v = model["v"]
    assert v[0] @ v[1] > 0


def test_margin_is_the_pairwise_sum():
    rng = np.random.default_rng(2)
    model = {"w": rng.normal(size=5), "v": rng.normal(size=(5, 3)), "b": 0.3}
    raw, _ = toxicity._margin(np.array([0, 0, 0]), np.array([0, 2, 4]), 2, model)
    want = 0.3 + model["w"][[0, 2, 4]].sum() + sum(model["v"][a] @ model["v"][b] for a, b in ((0, 2), (0, 4), (2, 4)))
    assert np.isclose(raw[0], want) and raw[1] == 0.3


def test_factors_find_planted_pairs(spark, docs):
    """An insult at a thing and a group's name alone are clean, both together toxic: without the factors most of these are missed."""
    rng = np.random.default_rng(7)
    insults, groups, filler = (["vile", "wretch", "scum"], ["northfolk", "hillmen", "rivers"], [f"word{i}" for i in range(60)])
    rows, toxic = [], []
    for i in range(1500):
        bad, group = rng.random(2) < 0.5
        words = list(rng.choice(filler, 12)) + [str(rng.choice(insults))] * int(bad) + [str(rng.choice(groups))] * int(group)
        rows.append((i, " ".join(map(str, rng.permutation(words))), "en", "a"))
        toxic.append((i, int(bad and group)))
    labels = spark.createDataFrame(toxic, "doc_id long, toxic int")
    model = toxicity.learn(toxicity.learnable(docs(rows)), toxicity.learnable(labels))
    texts, y = [r[1] for r in rows], np.array([t for _, t in toxic]) > 0

    def found(m):
        p = toxicity.probabilities(texts, m) >= 0.7
        return p[y].mean(), p[~y].mean()

    recall, wrong = found(model)
    flat, _ = found(model | {"v": np.zeros_like(model["v"])})
    assert recall > 0.95 and wrong < 0.02 and flat < recall - 0.3


def test_rows_are_bounded_not_ids(spark, docs):
    """One labelled id with many texts, and one row many times over."""
    rows = [(1, f"text number {i} of one id", "en", "a") for i in range(4000)] + [(2, "the same row", "en", "a")] * 4000 + [(3, "an insult", "en", "a")]
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    seen, train = [], toxicity.train
    try:
        toxicity.train = lambda of, col, y, chosen: seen.append(len(y)) or train(of, col, y, chosen)
        toxicity.learn(docs(rows), labels, max_rows=500)
    finally:
        toxicity.train = train
    assert 300 < seen[0] <= 750


def test_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        got = toxicity.toxicity_query(odd, lab)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        assert got.count() == 10 and got.filter("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.toxicity_query(docs([]), labels).count() == 0
    assert toxicity.toxicity_stage(odd, labels).columns == odd.columns


def test_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs_, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity_query(docs_, labels).filter("held_out").join(labels, "doc_id")
    r = got.agg(*[F.sum(((F.col("predicted") == p) & (F.col("toxic") == t)).cast("int")).alias(f"n{p}{t}") for p in (0, 1) for t in (0, 1)]).first()
    assert r["n11"] / (r["n11"] + r["n01"]) > 0.8 and r["n10"] / (r["n10"] + r["n00"]) < 0.02
