"""Boosted trees on histograms, logistic loss (ML-2): of second order with L2 on leaves, or of first order.

Each feature is cut once at exact quantiles into at most ``max_bins`` bins, and rows are kept as blocks of columns (bins,
label, weight, log odds).  A level of a tree is one job over the blocks, the sums of gradient and Hessian by (node,
feature, bin): a task returns one array of ``2^depth x features x max_bins`` sums however many rows it has, and the
arrays are added up.  Prefix sums over a node's bins give every cut's gain, and the best cut of each node extends the tree.

With G, H the sums on a side: gain = (GL²/(HL+λ) + GR²/(HR+λ) − G²/(H+λ)) / 2, taken if above ``min_gain`` and both
Hessian sums reach ``min_child_weight`` (the sum of Hessians, not of rows); a leaf adds −G/(H+λ) times the learning
rate to the log odds, which start at 0.  Rows with ``x < cut`` go left.

Gradients and Hessians are summed as integers in units of 2^-24, so sums don't depend on the order of rows and a rerun on
other partitions gives the same trees; equal gains go to the earlier feature, then the smaller cut.  The integers hold
2^39 units of row weight.  A missing or NaN feature counts as 0, as in the training frame; rows without a label are
left out, a missing weight counts as 1.  One class only, or no rows: every tree is a single leaf.

``first_order`` gives the trees of Spark ML's ``GBTClassifier`` (log loss, variance impurity, mean residuals in the leaves):
a row's weight takes the Hessian's place, and there is no L2.  Its log odds are twice Spark ML's margin.
"""

from __future__ import annotations

import math
import random
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payrisk.operators.quantiles import quantiles_of, value_counts
from payrisk.session import checkpoint_root

SCALE = float(1 << 24)
LAND_EVERY = 20
#: Rows of a block.
BLOCK_ROWS = 1 << 16
#: Rows that a task takes at most.
TASK_ROWS = 4_000_000
#: Bytes of partial sums that may meet on the driver; above, tasks add them up among themselves first.
PARTIAL_BYTES = 1 << 26

MODEL_SCHEMA = "tree int, node int, feature string, cut double, value double, gain double"


@dataclass
class Node:
    """A leaf has a ``value`` and no ``feature``; the children of node i are 2i+1 (x < cut) and 2i+2."""

    feature: str | None = None
    cut: float | None = None
    value: float = 0.0
    gain: float | None = None


@dataclass
class BoostedTrees:
    """A fitted model: trees as maps from node number to :class:`Node`."""

    features: list[str]
    trees: list[dict[int, Node]] = field(default_factory=list)

    def margin(self) -> Column:
        """Log odds of class 1: the trees' leaves added in order."""
        if not self.trees:
            return F.lit(0.0)
        place = {f: i for i, f in enumerate(self.features)}
        depth = max(_depth(t) for t in self.trees)
        tables = [_table(t, depth, lambda n: (place[n.feature], n.cut), float) for t in self.trees]

        @F.pandas_udf("double")
        def votes(rows: pd.DataFrame) -> pd.Series:
            x = np.ascontiguousarray(rows.to_numpy("float64"))
            m = np.zeros(len(x))
            for feature, cut, value in tables:
                m += value[_descend(x, feature, cut, depth, np.greater_equal)]
            return pd.Series(m)

        return votes(F.struct(*[_number(f).alias(f"_{i}") for i, f in enumerate(self.features)]))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``probability`` vector (class 0, class 1), as Spark's own classifiers give it."""
        from pyspark.ml.functions import array_to_vector

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        return (df.withColumn("_margin", self.margin()).withColumn("_p", p)
                .withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p"))))
                .drop("_margin", "_p"))

    def importance(self) -> dict[str, float]:
        """Gain summed over each feature's cuts."""
        out = dict.fromkeys(self.features, 0.0)
        for n in (n for t in self.trees for n in t.values() if n.feature):
            out[n.feature] += n.gain
        return out

    def save(self, path: str) -> str:
        """One row per node under ``path/trees``; feature names in order under ``path/features``."""
        spark = SparkSession.active()
        rows = [(i, k, n.feature, n.cut, n.value, n.gain) for i, t in enumerate(self.trees) for k, n in t.items()]
        spark.createDataFrame(rows, MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        names = spark.createDataFrame(list(enumerate(self.features)), "place int, feature string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        return path

    @staticmethod
    def load(path: str) -> BoostedTrees:
        spark = SparkSession.active()
        names = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("place").collect()]
        trees: dict[int, dict[int, Node]] = {}
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():  # a model, not data
            trees.setdefault(r["tree"], {})[r["node"]] = Node(r["feature"], r["cut"], r["value"], r["gain"])
        return BoostedTrees(names, [trees[i] for i in sorted(trees)])


def _x(feature: str) -> str:
    return f"_x_{feature}"


def _number(feature: str) -> Column:
    return F.coalesce(F.nanvl(F.col(feature).cast("double"), F.lit(0.0)), F.lit(0.0))


def _depth(tree: dict[int, Node]) -> int:
    return (max(tree) + 1).bit_length() - 1


def _table(tree: dict[int, Node], depth: int, cut_of, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature place, cut, value) of all nodes down to ``depth``; a leaf's value stands at all places below it too."""
    size = 2 ** (depth + 1) - 1
    feature, cut, value = np.zeros(size, np.int64), np.zeros(size, kind), np.zeros(size)
    for i in range(size):
        n = tree.get(i)
        if n is None:
            value[i] = value[(i - 1) // 2]
        elif n.feature is None:
            value[i] = n.value
        else:
            feature[i], cut[i] = cut_of(n)
    return feature, cut, value


def _descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int, right) -> np.ndarray:
    """Each row's place after ``depth`` steps; ``right(value, cut)`` says who goes to 2i+2.  Below a leaf both ways are alike."""
    node = np.zeros(len(x), np.int64)
    flat, row = x.reshape(-1), np.arange(len(x)) * x.shape[1]
    for _ in range(depth):
        to_right = right(flat.take(row + feature.take(node)), cut.take(node))
        node = 2 * node + 1
        node += to_right
    return node


def _constants(values: list) -> Column:
    return F.expr(f"array({', '.join(f'{v!r}D' if isinstance(v, float) else str(v) for v in values)})")


def with_bins(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``_bins``: per feature, how many cuts are at or below the value (found by halving); 0 where there is no cut."""
    from pyspark.ml.feature import Bucketizer

    out = df.withColumns({_x(f): _number(f) for f in cuts})
    some = [f for f in cuts if cuts[f]]
    if some:
        ends = [[float("-inf"), *cuts[f], float("inf")] for f in some]
        out = Bucketizer(splitsArray=ends, inputCols=[_x(f) for f in some], outputCols=[f"_b_{f}" for f in some]).transform(out)
    bins = F.array(*[F.col(f"_b_{f}").cast("int") if cuts[f] else F.lit(0) for f in cuts])
    return out.withColumn("_bins", bins).drop(*map(_x, cuts), *[f"_b_{f}" for f in some])


def feature_cuts(df: DataFrame, features: list[str], max_bins: int = 256) -> dict[str, list[float]]:
    """Places where each feature may be cut: its distinct exact quantiles at i/max_bins, without the lowest."""
    probs = [i / max_bins for i in range(max_bins)]
    found = quantiles_of(value_counts(df.select(*[_number(f).alias(f) for f in features]), features), probs)
    return {f: sorted(set(found.get(f, [])))[1:] for f in features}


def gradients(df: DataFrame, label: str, weight: str | None, margin: Column) -> DataFrame:
    """``_g`` and ``_h``, the loss's derivatives by the log odds times the row's weight, in units of 2^-24."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return df.withColumns({"_g": F.round(w * (p - F.col(label).cast("double")) * SCALE).cast("long"),
                           "_h": F.round(w * p * (1.0 - p) * SCALE).cast("long")})


def histograms(df: DataFrame, node: Column, drawn: list[int] | None = None) -> DataFrame:
    """(node, feature place, bin, g, h) summed over rows whose ``node`` is not null; only the places ``drawn``, if given."""
    flat = df.select(node.cast("int").alias("node"), "_g", "_h", "_bins").where(F.col("node").isNotNull())
    flat = flat.select("node", "_g", "_h", F.posexplode("_bins").alias("feature", "bin"))
    if drawn is not None:
        flat = flat.where(F.get(_constants([i in drawn for i in range(max(drawn) + 1)]), F.col("feature")))
    return flat.groupBy("node", "feature", "bin").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))


def split_gains(hist: DataFrame, reg_lambda: float = 1.0) -> DataFrame:
    """(node, feature, bin, gl, hl, gt, ht, gain): the sums of bins up to this one, those of the node and the gain of
    cutting after this bin.  The window holds one node's bins of one feature, at most ``max_bins`` rows."""
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("node", "feature")
    s = hist.select("node", "feature", "bin", *[F.sum(c).over(w).alias(n) for c, w, n in (
        ("g", upto, "gl"), ("h", upto, "hl"), ("g", whole, "gt"), ("h", whole, "ht"))])

    def part(g: Column, h: Column) -> Column:
        g, h = g / F.lit(SCALE), h / F.lit(SCALE)
        return F.coalesce(F.try_divide(g * g, h + F.lit(float(reg_lambda))), F.lit(0.0))

    c = F.col
    gain = (part(c("gl"), c("hl")) + part(c("gt") - c("gl"), c("ht") - c("hl")) - part(c("gt"), c("ht"))) / 2.0
    return s.withColumn("gain", gain)


@dataclass
class Block:
    """Some rows by columns: ``bins`` (rows x features), ``draws`` (64-bit words x rows, see :func:`_draws`), ``margin`` the log odds."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    draws: np.ndarray
    margin: np.ndarray

    def moved(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], depth: int) -> Block:
        at = _descend(self.bins, *tree[:2], depth, np.greater)
        return Block(self.bins, self.label, self.weight, self.draws, self.margin + tree[2][at])

    def units(self, first_order: bool) -> list[np.ndarray]:
        """As :func:`gradients`; of first order, the weight is the Hessian."""
        p = 1.0 / (1.0 + np.exp(-self.margin))
        g, h = self.weight * (p - self.label), self.weight if first_order else self.weight * p * (1.0 - p)
        return [np.copysign(np.floor(np.abs(u * SCALE) + 0.5), u) for u in (g, h)]


def _draws(key: str, seed: int, trees: int, subsample: float) -> list[Column]:
    """Words of 64 bits that say which trees draw a row, each by a hash of its key."""
    limit, words = F.lit(round(subsample * (1 << 20))), []
    for lo in range(0, trees, 64):
        word = F.lit(0).cast("long")
        for t in range(lo, min(lo + 64, trees)):
            share = F.pmod(F.xxhash64(F.lit(seed), F.lit(t), F.col(key)), F.lit(1 << 20))
            word = word.bitwiseOR(F.shiftleft((share < limit).cast("long"), t - lo))
        words.append(word.alias(f"_d{lo // 64}"))
    return words


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser of splitmix64."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _drawn(b: Block, t: int, first_order: bool, subsample: float) -> np.ndarray | None:
    """Whether tree ``t`` draws a row, by its words; of first order, by its key's hash mixed with the tree's number."""
    if not len(b.draws):
        return None
    if not first_order:
        return (b.draws[t // 64] >> np.uint64(t % 64) & np.uint64(1)).astype(bool)
    return _mixed(b.draws[0] + np.uint64((t + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(44) < np.uint64(round(subsample * (1 << 20)))


def _blocks(df: DataFrame, features: int, words: int) -> RDD:
    """``df`` (``_y``, ``_w``, a bin per feature, words of draws) as blocks, in the partitions of ``df``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out():
            cols = [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            bins = np.stack(cols[2 : 2 + features], axis=1)
            bins = bins.astype(np.uint8 if bins.max(initial=0) < 256 else np.int32)
            parts = [bins, cols[0].astype(np.float32), cols[1], np.array(cols[2 + features :], np.int64).reshape(words, len(bins))]
            return pa.RecordBatch.from_arrays([pa.array([len(bins)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]],
                                              names=["n", "bins", "label", "weight", "draws"])

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= BLOCK_ROWS:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    def unpack(r) -> Block:
        n = r["n"]
        bins = np.frombuffer(r["bins"], np.uint8 if len(r["bins"]) == n * features else np.int32).reshape(n, features)
        return Block(bins, np.frombuffer(r["label"], np.float32), np.frombuffer(r["weight"]),
                     np.frombuffer(r["draws"], np.uint64).reshape(words, n), np.zeros(n))

    return df.mapInArrow(pack, "n int, bins binary, label binary, weight binary, draws binary").rdd.map(unpack)


def _exact(units: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(shift, part) of whole ``units``: in two halves where a sum of doubles might not be exact."""
    if np.abs(units).sum() < 2.0**53:
        return [(0, units)]
    high = np.floor(units / SCALE)
    return [(24, high), (0, units - high * SCALE)]


def level_sums(blocks: RDD, tree: tuple, depth: int, t: int, open_nodes: list[int], features: int, bins: int, first_order: bool,
               subsample: float = 1.0, count: bool = False) -> np.ndarray:
    """Sums (gradient, Hessian; with ``count`` also rows) by open node, feature and bin over the rows tree ``t`` draws."""
    nowhere = len(open_nodes) * bins  # a place behind the open nodes' for rows that don't count
    place = np.full(2 ** (depth + 1) - 1, nowhere)
    place[open_nodes] = np.arange(len(open_nodes)) * bins
    kinds, cells = 3 if count else 2, nowhere + bins

    def run(part: Iterator[Block]) -> Iterator[np.ndarray]:
        out = np.zeros((kinds, features, cells), np.int64)
        for b in part:
            start, drawn = place.take(_descend(b.bins, *tree[:2], depth, np.greater)), _drawn(b, t, first_order, subsample)
            if drawn is not None:
                start[~drawn] = nowhere
            units = [_exact(u) for u in b.units(first_order)]
            for f in range(features):
                at = start + b.bins[:, f]
                for k, parts in enumerate(units):
                    for shift, u in parts:
                        out[k, f] += np.bincount(at, weights=u, minlength=cells).astype(np.int64) << shift
                if count:
                    out[2, f] += np.bincount(at, minlength=cells)
        yield out[:, :, :nowhere]

    sums = blocks.mapPartitions(run)
    many = sums.getNumPartitions() * kinds * features * nowhere * 8 > PARTIAL_BYTES
    total = sums.treeReduce(np.add) if many else sums.reduce(np.add)
    return total.reshape(kinds, features, len(open_nodes), bins).transpose(2, 0, 1, 3)


@dataclass
class _Rule:
    """Which cut of a node is best, and what a leaf adds."""

    rate: float
    reg_lambda: float
    min_child_weight: float
    min_gain: float
    min_child_rows: int = 0

    def value(self, g: int, h: int) -> float:
        whole = float(h) / SCALE + self.reg_lambda
        return -self.rate * (float(g) / SCALE) / whole if whole > 0 else 0.0

    def best(self, sums: np.ndarray, drawn: list[int], n_cuts: list[int]) -> tuple | None:
        """(gain, feature, bin, gl, hl) of the best allowed cut of a node, or None; equal gains go to the first."""
        left = np.cumsum(sums, axis=2)
        whole = left[:, :, -1:]

        def part(s: np.ndarray) -> np.ndarray:
            g, h = s[0] / SCALE, s[1] / SCALE + self.reg_lambda
            return np.divide(g * g, h, out=np.zeros_like(g), where=h != 0)

        gain = (part(left) + part(whole - left) - part(whole)) / 2.0
        allowed = (gain > self.min_gain) & (left[1] / SCALE >= self.min_child_weight) & ((whole - left)[1] / SCALE >= self.min_child_weight)
        if self.min_child_rows:
            allowed &= (left[1] > 0) & ((whole - left)[1] > 0)
        if len(sums) > 2:
            allowed &= (left[2] >= self.min_child_rows) & ((whole - left)[2] >= self.min_child_rows)
        allowed &= np.isin(np.arange(len(n_cuts)), drawn)[:, None] & (np.arange(sums.shape[2]) < np.array(n_cuts)[:, None])
        if not allowed.any():
            return None
        f, k = np.unravel_index(np.where(allowed, gain, -np.inf).argmax(), gain.shape)
        return float(gain[f, k]), int(f), int(k), int(left[0, f, k]), int(left[1, f, k])


def fit_boosted(df: DataFrame, features: list[str], label: str, weight: str | None = None, n_estimators: int = 300,
                max_depth: int = 6, learning_rate: float = 0.05, reg_lambda: float = 1.0, min_child_weight: float = 1.0,
                min_gain: float = 0.0, max_bins: int = 256, subsample: float = 1.0, colsample: float = 1.0,
                row_key: str | None = None, seed: int = 42, first_order: bool = False, min_child_rows: int = 1) -> BoostedTrees:
    """Fit on ``df``.  ``subsample`` draws rows anew for each tree by a hash of ``row_key``, ``colsample`` features by
    ``seed``; both are the same in a rerun.  The blocks with the log odds so far are kept between trees, and written to the
    shared folder every ``LAND_EVERY`` trees, so a lost executor costs at most that many.

    ``first_order`` takes neither L2 nor Hessian: a child needs weight and ``min_child_rows`` rows, the first tree counts in full, and
    features are drawn for each node, ``colsample`` of them rounded up, as in Spark ML."""
    if subsample < 1.0 and row_key is None:
        raise ValueError("subsample needs row_key")
    features = list(features)
    checkpoint_root(df.sparkSession)
    cuts = feature_cuts(df, features, max_bins)
    model = BoostedTrees(features)
    draws = [] if subsample >= 1.0 else ([F.xxhash64(F.lit(seed), F.col(row_key)).alias("_d0")] if first_order
                                         else _draws(row_key, seed, n_estimators, subsample))
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    rows = with_bins(df.where(F.col(label).isNotNull()), cuts).select(
        F.col(label).cast("double").alias("_y"), w.alias("_w"), *[F.get("_bins", i).alias(f"_b{i}") for i in range(len(features))], *draws)
    # each level starts all tasks anew, so one a core, or as many more as the rows need
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = cores * math.ceil(max(df.count(), 1) / (cores * TASK_ROWS))
    blocks, last = _blocks(rows.repartition(tasks), len(features), len(draws)).persist(StorageLevel.MEMORY_AND_DISK), None
    for t in range(n_estimators):
        if first_order:
            # Spark ML fits the first tree to labels -1 and 1 (-2 times our gradient) and the others to residuals (-4 times); 2 x its margin
            rule, n_used = _Rule(4.0 if t == 0 else 8.0 * learning_rate, 0.0, 0.0, 0.0, min_child_rows), math.ceil(colsample * len(features))
        else:
            rule, n_used = _Rule(learning_rate, reg_lambda, min_child_weight, min_gain), max(1, round(colsample * len(features)))

        def drawn(node: int, t: int = t, n: int = n_used) -> list[int]:
            name = f"{seed}:{t}:{node}" if first_order else f"{seed}:{t}"
            return random.Random(name).sample(range(len(features)), n)

        tree = _grow(blocks, cuts, t, max_depth, rule, drawn, first_order, subsample)
        model.trees.append(tree)
        if last is not None:
            last.unpersist()  # the new blocks are held since the tree's first level
        if t + 1 < n_estimators:
            last, blocks = blocks, _moved(blocks, cuts, tree)
            if (t + 1) % LAND_EVERY == 0:
                blocks.checkpoint()
    blocks.unpersist()
    return model


def _binned(tree: dict[int, Node], cuts: dict[str, list[float]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names = list(cuts)
    return _table(tree, depth, lambda n: (names.index(n.feature), bisect_left(cuts[n.feature], n.cut)), np.int64)


def _moved(blocks: RDD, cuts: dict[str, list[float]], tree: dict[int, Node]) -> RDD:
    """The blocks with the tree's leaves added to their log odds, kept from the first job on."""
    depth = _depth(tree)
    table = _binned(tree, cuts, depth)
    return blocks.map(lambda b: b.moved(table, depth)).persist(StorageLevel.MEMORY_AND_DISK)


def _grow(blocks: RDD, cuts: dict[str, list[float]], t: int, max_depth: int, rule: _Rule, drawn: Callable, first_order: bool,
          subsample: float) -> dict[int, Node]:
    names, n_cuts = list(cuts), [len(c) for c in cuts.values()]
    tree: dict[int, Node] = {0: Node()}
    open_nodes = [0]
    for depth in range(max_depth):
        found = level_sums(blocks, _binned(tree, cuts, depth), depth, t, open_nodes, len(names), max(n_cuts) + 1, first_order, subsample,
                           rule.min_child_rows > 1)
        closed, open_nodes = open_nodes, []
        for i, sums in zip(closed, found):  # at most 2^depth nodes
            g, h = (int(x) for x in sums[:2, 0].sum(axis=1))
            tree[i].value = rule.value(g, h)
            best = rule.best(sums, drawn(i), n_cuts)
            if best is not None:
                gain, f, k, gl, hl = best
                tree[i] = Node(names[f], cuts[names[f]][k], 0.0, gain)
                for side, (gs, hs) in enumerate(((gl, hl), (g - gl, h - hl)), start=1):
                    tree[2 * i + side] = Node(value=rule.value(gs, hs))
                    open_nodes.append(2 * i + side)
        if not open_nodes:
            break
    return tree
