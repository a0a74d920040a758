"""Histogram boosting against a plain version, row by row; the L2 and Hessian rules; odd input."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from payrisk.operators import boosting as bo
from payrisk.operators.score import score_model
from payrisk.plans import train as tr

UNIT = 2.0**24
NAMES = ["a", "b", "c"]


def _rows(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.gauss(0, 1), r.randint(0, 6), r.random() * 100
        odds = 2 * (a > 0.3) * (b > 2) - 1 + 0.01 * c
        out.append((i, a, float(b), c, int(r.random() < 1 / (1 + math.exp(-odds))), 1.0 + (i % 3)))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, w double")


def _quantile_cuts(xs, bins):
    xs = sorted(xs)
    found = set()
    for i in range(bins):
        at = i / bins * (len(xs) - 1)
        lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
        found.add(lo if lo == hi else lo + (at - math.floor(at)) * (hi - lo))
    return sorted(found)[1:]


def _plain(rows, trees, depth, rate, lam, child, bins):
    """Every cut of every node tried over the rows that stand there."""
    xs = [r[1:4] for r in rows]
    cuts = [_quantile_cuts([x[j] for x in xs], bins) for j in range(3)]
    margin = [0.0] * len(rows)

    def part(g, h):
        return (g / UNIT) ** 2 / (h / UNIT + lam) if h / UNIT + lam else 0.0

    for _ in range(trees):
        grads = []
        for r, m in zip(rows, margin):
            p = 1 / (1 + math.exp(-m))
            grads.append((math.floor(abs(r[5] * (p - r[4]) * UNIT) + 0.5) * (1 if p >= r[4] else -1), math.floor(r[5] * p * (1 - p) * UNIT + 0.5)))

        def grow(ids, left):
            g, h = sum(grads[i][0] for i in ids), sum(grads[i][1] for i in ids)
            best = None
            for j in range(3) if left else ():
                for k, cut in enumerate(cuts[j]):
                    low = [i for i in ids if xs[i][j] < cut]
                    gl, hl = sum(grads[i][0] for i in low), sum(grads[i][1] for i in low)
                    if hl / UNIT < child or (h - hl) / UNIT < child:
                        continue
                    gain = (part(gl, hl) + part(g - gl, h - hl) - part(g, h)) / 2
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, j, cut)
            if best is None:
                for i in ids:
                    margin[i] += -rate * (g / UNIT) / (h / UNIT + lam)
                return
            _, j, cut = best
            grow([i for i in ids if xs[i][j] < cut], left - 1)
            grow([i for i in ids if xs[i][j] >= cut], left - 1)

        grow(list(range(len(rows))), depth)
    return margin


@pytest.mark.parametrize("lam,child", [(1.0, 1.0), (25.0, 8.0), (0.0, 0.0)])
def test_equals_a_plain_version(spark, lam, child):
    rows = _rows(500)
    model = bo.fit_boosted(_frame(spark, rows), NAMES, "y", "w", n_estimators=3, max_depth=3, learning_rate=0.3, reg_lambda=lam,
                           min_child_weight=child, max_bins=16)
    got = score_model(_frame(spark, rows).repartition(5), model, "t", features=NAMES).select("id", "fraud_probability").collect()
    want = _plain(rows, 3, 3, 0.3, lam, child, 16)
    assert len(got) == 500
    for r in got:
        assert r[1] == pytest.approx(1 / (1 + math.exp(-want[r[0]])), abs=1e-9)


def test_same_trees_on_other_partitions(spark):
    df = _frame(spark, _rows(400, 2))
    fit = [bo.fit_boosted(df.repartition(n), NAMES, "y", "w", n_estimators=3, max_depth=3, max_bins=32, subsample=0.7, colsample=0.67, row_key="id")
           for n in (1, 7)]
    assert fit[0].trees == fit[1].trees
    assert any(n.feature for t in fit[0].trees for n in t.values())
    assert all(len({n.feature for n in t.values() if n.feature}) <= 2 for t in fit[0].trees)


def test_l2_shrinks_leaves_and_child_weight_is_a_hessian(spark):
    df = _frame(spark, _rows(300, 3))
    leaf = lambda m: max(abs(n.value) for t in m.trees for n in t.values())
    loose, tight = (bo.fit_boosted(df, NAMES, "y", n_estimators=1, max_depth=2, reg_lambda=x, max_bins=16) for x in (0.0, 50.0))
    assert leaf(tight) < leaf(loose)
    # 300 rows have a Hessian sum of 75 at log odds 0, so no cut leaves 40 on both sides though 150 rows could
    assert bo.fit_boosted(df, NAMES, "y", n_estimators=1, max_depth=2, min_child_weight=40.0, max_bins=16).trees[0].keys() == {0}


def test_many_trees_are_landed_between(spark, monkeypatch):
    df = _frame(spark, _rows(200, 4))
    whole = bo.fit_boosted(df, NAMES, "y", n_estimators=5, max_depth=2, max_bins=8)
    monkeypatch.setattr(bo, "LAND_EVERY", 2)
    assert bo.fit_boosted(df, NAMES, "y", n_estimators=5, max_depth=2, max_bins=8).trees == whole.trees


def test_odd_input(spark):
    odd = [(1, None, 1.0, float("nan"), 1, None), (2, 0.5, None, 2.0, 0, 1.0), (3, 0.5, 3.0, 1.0, None, 1.0), (4, -1.0, 0.0, 0.0, 0, 1.0)]
    model = bo.fit_boosted(_frame(spark, odd), NAMES, "y", "w", n_estimators=2, max_depth=2, min_child_weight=0.0)
    scored = score_model(_frame(spark, odd).withColumn("probability", F.lit("x")).drop("probability"), model, "t", features=NAMES)
    assert scored.where("fraud_probability between 0 and 1").count() == 4
    one = [(i, float(i), 1.0, 1.0, 0, 1.0) for i in range(20)]
    assert all(n.value < 0 for n in bo.fit_boosted(_frame(spark, one), NAMES, "y", n_estimators=1, max_depth=2).trees[0].values() if not n.feature)
    none = bo.fit_boosted(_frame(spark, []), NAMES, "y", n_estimators=2, max_depth=2)
    assert [t.keys() for t in none.trees] == [{0}, {0}]
    assert score_model(_frame(spark, odd), none, "t", features=NAMES).where("fraud_probability = 0.5").count() == 4


def test_saved_and_loaded(spark, tmp_path):
    df = _frame(spark, _rows(200, 5))
    model = bo.fit_boosted(df, NAMES, "y", n_estimators=2, max_depth=2, max_bins=8)
    path = tr.save_model(model, str(tmp_path / "hist"))
    loaded, version = tr.load_model_or_fallback(path)
    assert version == "hist" and loaded == model
    assert set(model.importance()) == set(NAMES) and max(model.importance().values()) > 0


def test_first_order_is_spark_mls_gbt(spark):
    """Few distinct values, so both may cut at the same places; no draws.  Weights and labels as in training."""
    rows = [(r[0], round(r[1]), r[2], r[3] // 20, r[4], r[5]) for r in _rows(600, 6)]
    df = _frame(spark, [(i, float(a), b, float(c), y, w) for i, a, b, c, y, w in rows]).cache()
    ours = bo.fit_boosted(df, NAMES, "y", "w", n_estimators=4, max_depth=3, learning_rate=0.1, first_order=True)
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    gbt = GBTClassifier(labelCol="y", weightCol="w", maxIter=4, maxDepth=3, stepSize=0.1, maxBins=256, featureSubsetStrategy="all")
    theirs = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), gbt]).fit(df)
    want = dict(score_model(df, theirs, "t", features=NAMES).select("id", "fraud_probability").collect())
    got = dict(score_model(df, ours, "t", features=NAMES).select("id", "fraud_probability").collect())
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-5


@pytest.mark.parametrize("first_order", [False, True])
def test_a_level_is_one_job(spark, first_order):
    df, sc = _frame(spark, _rows(300, 7)), spark.sparkContext

    def jobs(trees):
        sc.setJobGroup(f"boost-{first_order}-{trees}", "")
        bo.fit_boosted(df, NAMES, "y", "w", n_estimators=trees, max_depth=3, max_bins=16, subsample=0.9, row_key="id", first_order=first_order)
        return len(sc.statusTracker().getJobIdsForGroup(f"boost-{first_order}-{trees}"))

    few, many = jobs(1), jobs(4)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < many - few <= 3 * 3


def test_sums_beyond_doubles_stay_exact():
    u = np.array([2.0**52, 3.0, 2.0**52, 5.0])
    assert sum(int(p.sum()) << shift for shift, p in bo._exact(u)) == 2**53 + 8 and len(bo._exact(u)) == 2
