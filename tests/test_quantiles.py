"""Exact quantiles equal numpy's linear quantiles."""
import numpy as np
import pytest

from payrisk.operators import quantiles
from payrisk.operators.quantiles import (bracket_counts, column_quantiles, exact_quantiles, flat_values, quantiles_of,
                                         rank_brackets, running_sums, value_counts)

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.95, 0.999, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.lognormal(3, 1, 20000).round(3), np.full(15000, 7.0), rng.normal(0, 1, 5000)])
    return vals, spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "x double").repartition(4)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_matches_numpy(spark, data, parts):
    vals, df = data
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = exact_quantiles(df, "x", PROBS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert np.allclose(got, np.quantile(vals, PROBS), rtol=0, atol=1e-9)


def test_columns_in_one_pass(spark, data):
    vals, df = data
    both = df.selectExpr("x", "-x as y", "cast(null as double) as z")
    got = quantiles_of(value_counts(both, ["x", "y", "z"]), PROBS)
    assert set(got) == {"x", "y"}
    assert np.allclose(got["y"], np.quantile(-vals, PROBS), atol=1e-9)


def test_running_sums(spark):
    rows = [(g, float(x), (x * 7) % 5) for g in ("a", "b") for x in range(50)]
    df = spark.createDataFrame(rows, "g string, x double, n long").repartition(6)
    for down in (False, True):
        got = {(r["g"], r["x"]): r["cum_n"] for r in running_sums(df, "g", "x", ["n"], descending=down).collect()}
        for g, x, _ in rows:
            assert got[(g, x)] == sum(n for h, y, n in rows if h == g and (y >= x if down else y <= x))


def test_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_only_the_brackets_are_counted_one_by_one(spark, data):
    vals, df = data
    flat = flat_values(df, ["x"])
    brackets = rank_brackets(flat, [0.1, 0.5, 0.9])
    counts = bracket_counts(flat, brackets).collect()
    assert sum(r["n"] for r in counts) == len(vals)
    assert len(counts) < 0.02 * len(set(vals))
    ends = [e for b in brackets["x"] for e in b]
    assert ends == sorted(ends)


@pytest.mark.parametrize("accuracy,grid", [(2, 3), (10, 4), (50, 400)])
def test_a_rough_sketch_gives_the_same_values(spark, data, accuracy, grid):
    vals, df = data
    got = column_quantiles(flat_values(df.selectExpr("x", "-x as y"), ["x", "y"]), PROBS, accuracy, grid)
    assert np.allclose(got["x"], np.quantile(vals, PROBS), rtol=0, atol=1e-9)
    assert np.allclose(got["y"], np.quantile(-vals, PROBS), rtol=0, atol=1e-9)


def test_a_rank_outside_its_bracket_is_counted_in_full(spark, data, monkeypatch):
    vals, df = data
    monkeypatch.setattr(quantiles, "rank_brackets", lambda *a: {"x": [(7.0, 7.0)]})
    flat = flat_values(df, ["x"])
    assert quantiles_of(bracket_counts(flat, {"x": [(7.0, 7.0)]}), [0.01]) == {}
    assert np.allclose(column_quantiles(flat, PROBS)["x"], np.quantile(vals, PROBS), rtol=0, atol=1e-9)


def test_infinite_and_single_values(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "x double")
    assert exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == [float("-inf"), 1.0, float("inf")]
    assert exact_quantiles(df.where("x = 1.0"), "x", [0.0, 0.3, 1.0]) == [1.0, 1.0, 1.0]
