"""Population stability index (AGG-11, AGG-12, AGG-13).

Bins come from the *expected* side: decile edges by exact linear-interpolated
quantiles (bracketed by a sketch, then refined, see
``payrisk.operators.quantiles``), outer edges replaced by ±∞, duplicate edges
merged.  Bins are
right-closed ``(e_i, e_{i+1}]``: a value's bin is the number of inner edges
strictly below it.  Both sides are binned in one pass over their union
(the nine-number edge array is a literal or a scalar subquery; no data goes
through the driver),
counted per bin, joined to the full bin spine so empty bins count 0, then
smoothed: ``p = (count/n + eps) / Σ(count/n + eps)``;
``PSI = Σ (a − e)·ln(a / e)``.  NaN when a side is empty; 0.0 when the
expected side yields fewer than three edges (no inner edge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.operators.quantiles import column_quantiles, flat_values


def _clean(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    x = F.col(col).try_cast("double")
    n = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return df.select(x.alias("_x"), n.alias("_n")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))


def inner_edges_of(flat: DataFrame, bins: int = S.PSI_BINS) -> dict[str, list[float]]:
    """Sorted distinct inner decile edges of every column in ``flat(c, x)`` (:func:`payrisk.operators.quantiles.flat_values`),
    at most ``bins − 1`` numbers each; a column without values is left out."""
    return {c: sorted(set(q)) for c, q in column_quantiles(flat, [i / bins for i in range(1, bins)]).items()}


def edge_columns(flat: DataFrame, cols: list[str], bins: int = S.PSI_BINS) -> dict[str, Column]:
    """:func:`inner_edges_of` as literal arrays; null for a column without values."""
    got = inner_edges_of(flat, bins)
    return {c: F.array(*[F.lit(float(v)) for v in got[c]]) if c in got else F.lit(None).cast("array<double>") for c in cols}


def inner_edges(expected: DataFrame, col: str, bins: int = S.PSI_BINS) -> Column:
    """:func:`edge_columns` of one column."""
    return edge_columns(flat_values(expected, [col]), [col], bins)[col]


def bin_of(x: Column, edges: Column, max_edges: int = S.PSI_BINS - 1) -> Column:
    """AGG-11: right-closed bin index = number of edges strictly below x
    (``max_edges`` plain comparisons; a missing edge compares as false)."""
    return sum((F.coalesce((F.get(edges, i) < x), F.lit(False))).cast("int") for i in range(max_edges))


def psi_bins(expected: DataFrame, actual: DataFrame, col: str, actual_col: str | None = None,
             bins: int = S.PSI_BINS, eps: float = S.PSI_EPS, edges: Column | None = None,
             weight: str | None = None) -> DataFrame:
    """Per-bin counts and smoothed shares of both sides:
    ``bin, n_expected_bin, n_actual_bin, e_share, a_share`` (one row per bin)."""
    actual_col = actual_col or col
    e = _clean(expected, col, weight)
    a = _clean(actual, actual_col, weight)
    edges = edges if edges is not None else inner_edges(expected, col, bins)
    both = (e.select("_x", F.col("_n").alias("_e"), F.lit(0).cast("long").alias("_a"))
             .unionByName(a.select("_x", F.lit(0).cast("long").alias("_e"), F.col("_n").alias("_a"))))
    binned = both.withColumn("_edges", edges).select(bin_of(F.col("_x"), F.col("_edges"), bins - 1).alias("bin"),
                                                     "_e", "_a")
    counts = binned.groupBy("bin").agg(F.sum("_e").cast("long").alias("ne"), F.sum("_a").cast("long").alias("na"))
    # bin spine 0..k-1 with k = #inner edges + 1 (at most `bins` rows)
    spine = (expected.sparkSession.range(1)
             .select(F.explode(F.sequence(F.lit(0), F.size(edges))).alias("_bin"))
             .select(F.col("_bin").cast("int").alias("bin")))
    t = spine.join(counts, "bin", "left").na.fill(0, ["ne", "na"])
    allw = Window.partitionBy(F.lit(0))  # ≤ bins rows
    t = (t.withColumn("n_expected", F.sum("ne").over(allw)).withColumn("n_actual", F.sum("na").over(allw))
          .withColumn("k", F.count(F.lit(1)).over(allw)))
    e_p = F.col("ne") / F.greatest(F.col("n_expected"), F.lit(1))
    a_p = F.col("na") / F.greatest(F.col("n_actual"), F.lit(1))
    t = (t.withColumn("e_share", (e_p + F.lit(eps)) / (F.lit(1.0) + F.col("k") * F.lit(eps)))
          .withColumn("a_share", (a_p + F.lit(eps)) / (F.lit(1.0) + F.col("k") * F.lit(eps))))
    return t.select("bin", F.col("ne").alias("n_expected_bin"), F.col("na").alias("n_actual_bin"),
                    "e_share", "a_share", "n_expected", "n_actual", "k")


def psi(expected: DataFrame, actual: DataFrame, col: str, actual_col: str | None = None,
        bins: int = S.PSI_BINS, eps: float = S.PSI_EPS, name: str | None = None, edges: Column | None = None,
        weight: str | None = None) -> DataFrame:
    """AGG-12: one row ``feature, psi, n_bins, n_expected, n_actual``
    (``edges``: precomputed inner edges, e.g. from :func:`inner_edges`; ``weight``: a
    column with the number of rows that each input row stands for)."""
    t = psi_bins(expected, actual, col, actual_col, bins, eps, edges, weight)
    term = (F.col("a_share") - F.col("e_share")) * F.log(F.col("a_share") / F.col("e_share"))
    agg = t.agg(F.sum(term).alias("_psi"), F.coalesce(F.max("k"), F.lit(0)).alias("n_bins"),
                F.coalesce(F.max("n_expected"), F.lit(0)).alias("n_expected"),
                F.coalesce(F.max("n_actual"), F.lit(0)).alias("n_actual"))
    # an empty expected side has no edges and no spine: n_expected = 0 → NaN
    value = (F.when((F.col("n_expected") == 0) | (F.col("n_actual") == 0), F.lit(float("nan")))
              .when(F.col("n_bins") < 2, F.lit(0.0))
              .otherwise(F.col("_psi")))
    return agg.select(F.lit(name or col).alias("feature"), value.alias("psi"), F.col("n_bins").cast("int").alias("n_bins"),
                      F.col("n_expected").cast("long").alias("n_expected"), F.col("n_actual").cast("long").alias("n_actual"))


def psi_of_columns(sides: DataFrame, edges: dict[str, list[float]], eps: float = S.PSI_EPS) -> DataFrame:
    """AGG-12 for many columns in one grouped pass: ``feature, psi, n_bins, n_expected, n_actual`` per column of ``edges``
    (:func:`inner_edges_of`), from ``sides(c, x, expected)``, a row per value with the side it stands on.  Empty bins count 0;
    NaN where a side is empty, 0.0 where there is no inner edge."""
    spark = sides.sparkSession
    most = max((len(e) for e in edges.values()), default=0)
    of_column = F.lit(None).cast("array<double>")
    for c, e in edges.items():
        of_column = F.when(F.col("c") == c, F.array(*[F.lit(float(v)) for v in e]).cast("array<double>")).otherwise(of_column)
    binned = sides.withColumn("_edges", of_column).select("c", bin_of(F.col("x"), F.col("_edges"), most).alias("bin") if most
                                                          else F.lit(0).alias("bin"), "expected")
    counts = binned.groupBy("c", "bin").agg(F.count_if("expected").alias("ne"), F.count_if(~F.col("expected")).alias("na"))
    spine = spark.createDataFrame([(c, i, len(e) + 1) for c, e in edges.items() for i in range(len(e) + 1)], "c string, bin int, k int")
    t = F.broadcast(spine).join(counts, ["c", "bin"], "left").na.fill(0, ["ne", "na"])  # at most a row per column and bin
    whole = Window.partitionBy("c")
    t = t.withColumn("n_expected", F.sum("ne").over(whole)).withColumn("n_actual", F.sum("na").over(whole))

    def share(n: str, total: str) -> Column:
        return (F.col(n) / F.greatest(F.col(total), F.lit(1)) + F.lit(eps)) / (F.lit(1.0) + F.col("k") * F.lit(eps))

    t = t.withColumn("_e", share("ne", "n_expected")).withColumn("_a", share("na", "n_actual"))
    total = t.groupBy("c").agg(F.sum((F.col("_a") - F.col("_e")) * F.log(F.col("_a") / F.col("_e"))).alias("_psi"),
                               F.max("k").alias("n_bins"), F.max("n_expected").alias("n_expected"), F.max("n_actual").alias("n_actual"))
    value = (F.when((F.col("n_expected") == 0) | (F.col("n_actual") == 0), F.lit(float("nan")))
              .when(F.col("n_bins") < 2, F.lit(0.0)).otherwise(F.col("_psi")))
    return total.select(F.col("c").alias("feature"), value.alias("psi"), "n_bins", "n_expected", "n_actual")
