"""Exact quantiles and running sums over values, for any number of rows (AGG-5, AGG-8, AGG-12).

Quantiles are bracketed, then refined.  A mergeable quantile sketch (Spark's ``percentile_approx``, of bounded size and
known rank error) puts every wanted rank between two values; a second scan counts the values inside those brackets one by
one and everything between two brackets as one row.  Only the brackets' values, some thousandths of the rows for each
probability, are shuffled, range-partitioned and landed.  Should a rank stand outside its bracket, its column is counted
in full, so the result never rests on the sketch.

Running sums: rows are range-partitioned by Spark and landed with their range's number; ranges are in value order, so a
value's running sum is the total of the earlier ranges (one row per range) plus a window inside its range.  No value map
in one task, no loop on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.session import scratch_path

#: The sketch's rank error is rows / ACCURACY; it is asked for GRID + 1 values of each column.
ACCURACY = 10_000
GRID = 2_000


def running_sums(df: DataFrame, group: str, order: str, values: list[str], descending: bool = False) -> DataFrame:
    """``df`` (one row per ``group`` and ``order``) with ``cum_<v>``: the sum of v over rows up to and with this one."""
    spark = df.sparkSession
    key = F.col(order).desc() if descending else F.col(order)
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(group, key).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    landed = spark.read.parquet(path)
    totals = landed.groupBy(group, "_range").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_range", *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}") for v in values])
    inside = Window.partitionBy(group, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = landed.withColumns({f"_w_{v}": F.sum(v).over(inside) for v in values}).join(offsets, [group, "_range"])
    return (sums.withColumns({f"cum_{v}": F.col(f"_o_{v}") + F.col(f"_w_{v}") for v in values})
            .drop("_range", *[f"_{k}_{v}" for k in "ow" for v in values]))


def flat_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(c, x): every value of every column as a double; nulls and NaN are left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).try_cast("double").alias("x")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.*").where(F.col("x").isNotNull() & ~F.isnan("x"))


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(c, x, n): how often each value stands in each column; nulls and NaN are left out."""
    return flat_values(df, cols).groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))


def rank_brackets(flat: DataFrame, probs: list[float], accuracy: int = ACCURACY, grid: int = GRID) -> dict[str, list[tuple[float, float]]]:
    """For every column of ``flat(c, x)`` disjoint ascending intervals that hold the values at the ranks of ``probs``,
    by one aggregation of bounded size; the driver gets ``grid + 1`` values a column."""
    sketch = flat.groupBy("c").agg(F.count(F.lit(1)).alias("n"),
                                   F.percentile_approx("x", [i / grid for i in range(grid + 1)], accuracy).alias("q")).collect()
    out: dict[str, list[tuple[float, float]]] = {}
    for c, n, q in sketch:
        spare = n / accuracy + 1.0  # ranks by which the sketch may be off, and one for rounding
        found: list[tuple[float, float]] = []
        for p in sorted(probs):
            place = p * (n - 1)
            lo = q[max(0, math.floor((math.floor(place) - spare) * grid / n))]
            hi = q[min(grid, math.ceil((math.ceil(place) + 1 + spare) * grid / n))]
            if found and lo <= found[-1][1]:
                lo, hi = found[-1][0], max(hi, found.pop()[1])
            found.append((lo, hi))
        out[c] = found
    return out


def bracket_counts(flat: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(c, x, n, top): the counts of the values inside the brackets, and a row for all values between two brackets, with
    their smallest as ``x`` and their largest as ``top`` (equal to ``x`` for a single value)."""
    def of_column(pick) -> Column:
        e = F.lit(None).cast("array<double>")
        for c, found in brackets.items():
            e = F.when(F.col("c") == c, F.array(*[F.lit(float(pick(b))) for b in found])).otherwise(e)
        return e

    most = max((len(b) for b in brackets.values()), default=0)
    starts = F.lit(0)
    for i in range(most):
        starts = starts + F.coalesce((F.get("_lo", F.lit(i)) <= F.col("x")).cast("int"), F.lit(0))
    placed = flat.select("c", "x", of_column(lambda b: b[0]).alias("_lo"), of_column(lambda b: b[1]).alias("_hi"))
    placed = placed.select("c", "x", "_hi", starts.alias("_g"))
    inside = F.when((F.col("_g") > 0) & (F.col("x") <= F.get("_hi", F.col("_g") - 1)), F.col("x"))
    return (placed.select("c", "x", "_g", inside.alias("_in")).groupBy("c", "_g", "_in")
            .agg(F.min("x").alias("x"), F.count(F.lit(1)).alias("n"), F.max("x").alias("top")).select("c", "x", "n", "top"))


def column_quantiles(flat: DataFrame, probs: list[float], accuracy: int = ACCURACY, grid: int = GRID) -> dict[str, list[float]]:
    """Exact linearly interpolated quantiles of every column in ``flat(c, x)`` (:func:`flat_values`), which is scanned
    twice; a column without values is left out."""
    brackets = rank_brackets(flat, probs, accuracy, grid)
    if not brackets:
        return {}
    out = quantiles_of(bracket_counts(flat, brackets), probs)
    missed = [c for c in brackets if c not in out]
    if missed:
        full = flat.where(F.col("c").isin(missed)).groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
        out.update(quantiles_of(full, probs))
    return out


def quantiles_of(counts: DataFrame, probs: list[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of every column in ``counts(c, x, n)``; the driver gets two values per probability.
    With ``top`` (:func:`bracket_counts`) a column with a rank among several values counted as one is left out."""
    if "top" not in counts.columns:
        counts = counts.withColumn("top", F.col("x"))
    ranked = running_sums(counts, "c", "x", ["n"])
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    total = ranked.groupBy("c").agg(F.max("cum_n").alias("rows")).select("c", "rows", wanted.alias("w")).select(
        "c", "rows", "w.i", (F.col("w.p") * (F.col("rows") - 1)).alias("place"))
    # targets: a row per column and probability, named by the caller
    hit = ranked.join(F.broadcast(total), "c").where(
        (F.col("cum_n") > F.floor("place")) & (F.col("cum_n") - F.col("n") <= F.ceil("place")))
    out: dict[str, list] = {}
    unsure = set()
    for (c, i), rows in _grouped(hit.select("c", "i", "place", "x", "n", "cum_n", "top").collect()).items():
        place = rows[0]["place"]
        if any(r["top"] != r["x"] for r in rows):
            unsure.add(c)
            continue
        at = {k: next(r["x"] for r in rows if r["cum_n"] - r["n"] <= k < r["cum_n"]) for k in {math.floor(place), math.ceil(place)}}
        lo, hi = at[math.floor(place)], at[math.ceil(place)]
        out.setdefault(c, [None] * len(probs))[i] = lo if lo == hi else lo + (place - math.floor(place)) * (hi - lo)
    return {c: q for c, q in out.items() if c not in unsure}


def _grouped(rows: list) -> dict[tuple, list]:
    out: dict[tuple, list] = {}
    for r in rows:
        out.setdefault((r["c"], r["i"]), []).append(r)
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Exact linearly interpolated quantiles of ``df[col]``; ``None`` for each probability when there are no values."""
    return column_quantiles(flat_values(df, [col]), probs).get(col, [None] * len(probs))
