"""Embedding near-dedup (operator 3): a forest of random-projection trees with spill overlap.

Every tree splits by random directions at the median of a bounded sample; a vector within the spill margin of a split goes
to both sides.  Vectors of one label that share a leaf are compared by cosine in double precision; a leaf with more rows
than a block is compared by pairs of blocks, so none is skipped.  A pair that meets in several leaves is counted in the
first one only.  Blocks emit counts and the edges of a spanning star, never the pairs.

The margin is half the spread that the projection difference of a pair at the threshold has: such a pair is parted by a
split in about 2 % of cases, and must be parted in every tree to be missed.

Cases: null or zero vectors, and those with null or non-finite components, link with nothing, nor does a null label; vectors of
different lengths are not compared; equal vectors are one class, and link; a null id is never a component's id
unless all its members' are; repeated rows are copies; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import block_pairs, components, land

SIMILAR = 0.93
TREES = 4
LEAF_ROWS = 2_000
BLOCK = 1_024
LEAF = 1 << 32


def unpack(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors as float64; None for those that link with nothing."""
    lengths = column.value_lengths().to_pylist()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum([n or 0 for n in lengths])
    out: list[np.ndarray | None] = []
    for n, end in zip(lengths, ends):
        v = values[end - n : end] if n else None
        out.append(v if v is not None and np.isfinite(v).all() and v.any() else None)
    return out


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def _direction(seed: int, tree: int, node: int, dim: int) -> np.ndarray:
    d = np.random.default_rng([seed, tree, node]).normal(size=dim)
    return d / np.sqrt((d * d).sum())


def plant(sample: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, similar: float = SIMILAR, seed: int = 3) -> list[dict]:
    """Trees for vectors of one length, fitted on unit vectors: splits {number: threshold}, children 2k+1 and 2k+2.

    Where the sample runs out before the expected rows of a node are few enough, "deep" holds the sample's mean there and the levels still
    to split: those splits lie at the mean, so the trees grow with the rows, not with the sample.
    """
    dim, out = sample.shape[1], []
    for t in range(trees):
        splits, deep, stack = {}, {}, [(0, np.arange(len(sample)))]
        while stack:
            k, at = stack.pop()
            expected = len(at) * rows / len(sample)
            if expected <= leaf_rows or k >= LEAF // 4:
                continue
            if len(at) < 32:
                deep[k] = (sample[at].mean(axis=0) if len(at) else np.zeros(dim), int(np.ceil(np.log2(expected / leaf_rows))))
                continue
            p = sample[at] @ _direction(seed, t, k, dim)
            splits[k] = float(np.median(p))
            stack += [(2 * k + 1, at[p <= splits[k]]), (2 * k + 2, at[p > splits[k]])]
        out.append({"splits": splits, "deep": deep, "seed": seed, "margin": 0.5 * float(np.sqrt((2 - 2 * similar) / dim))})
    return out


def leaves(x: np.ndarray, forest: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf code) of unit vectors, a code being tree * LEAF + node, sorted by row and code."""
    rows, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for t, tree in enumerate(forest):
        stack = [(0, np.arange(len(x)), None, 0)]
        while stack:
            k, at, mean, left = stack.pop()
            if not len(at):
                continue
            if k in tree["deep"]:
                mean, left = tree["deep"][k]
            if k not in tree["splits"] and (left == 0 or k >= LEAF // 4):
                rows.append(at)
                codes.append(np.full(len(at), t * LEAF + k))
                continue
            d = _direction(tree["seed"], t, k, x.shape[1])
            split = tree["splits"][k] if k in tree["splits"] else float(mean @ d)
            p, below = x[at] @ d, max(left - 1, 0)
            stack += [(2 * k + 1, at[p <= split + tree["margin"]], mean, below), (2 * k + 2, at[p > split - tree["margin"]], mean, below)]
    row, code = np.concatenate(rows), np.concatenate(codes)
    order = np.lexsort((code, row))
    return row[order], code[order]


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which rows have a leaf in common, by incidence of leaves."""
    seen, at = np.unique(np.concatenate([*left, *right, np.zeros(0, np.int64)]), return_inverse=True)
    z = np.zeros((len(left) + len(right), max(len(seen), 1)), np.float32)
    z[np.repeat(np.arange(len(z)), [len(c) for c in (*left, *right)]), at] = 1
    return z[: len(left)] @ z[len(left) :].T > 0


def compare(cid: np.ndarray, n: np.ndarray, x: np.ndarray, codes: list[np.ndarray], side: np.ndarray, same: bool, code: int, similar: float):
    """(links per row counted here, least class reachable within the block) for one pair of blocks."""
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    near = x[left] @ x[right].T >= similar
    if same:
        np.fill_diagonal(near, False)
    links, root = np.zeros(len(cid), np.int64), cid.copy()
    li, ri = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if len(li):
        some = near[np.ix_(li, ri)]
        earlier = _shared([codes[k][codes[k] < code] for k in left[li]], [codes[k][codes[k] < code] for k in right[ri]])
        mine = some & ~earlier
        links[left[li]] += mine @ n[right[ri]]
        if not same:
            links[right[ri]] += mine.T @ n[left[li]]
        a, b = left[li], right[ri]
        while True:  # least class along links
            low_a = np.minimum(root[a], np.where(some, root[b][None, :], np.iinfo(np.int64).max).min(axis=1))
            changed = (low_a < root[a]).any()
            root[a] = low_a
            low_b = np.minimum(root[b], np.where(some, root[a][:, None], np.iinfo(np.int64).max).min(axis=0))
            changed |= (low_b < root[b]).any()
            root[b] = low_b
            if not changed:
                break
    return links, root


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 similar: float = SIMILAR, sample_rows: int = 20_000) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector; ``sample_rows`` bounds the sample the trees are fitted on."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            labels, got = b.column(2).to_pylist(), unpack(b.column(1))
            blobs = [unit(v).tobytes() if v is not None and label is not None else None for v, label in zip(got, labels)]
            keys = [hashlib.md5(f"{label}:".encode() + v.tobytes()).hexdigest() if s else None for v, label, s in zip(got, labels, blobs)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + len(keys))), b.column(0), pa.array(labels, pa.string()), pa.array(keys, pa.string()), pa.array(blobs, pa.binary())],
                                             names=["uid", "id", "label", "key", "v"])
            uid += len(keys)

    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    rows = land(src.mapInArrow(read, "uid long, id long, label string, key string, v binary"), "vec-rows")
    classes = land(rows.filter("key is not null").groupBy("key").agg(F.min("uid").alias("cid"), F.min("id").alias("least"), F.count(F.lit(1)).alias("n"),
                                                                     F.first("label").alias("label"), F.first("v").alias("v")), "vec-classes")
    sizes = {r["bytes"]: r["n"] for r in classes.groupBy(F.octet_length("v").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = max(sum(sizes.values()), 1)
    sample = classes.filter(F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_rows / total))).select("v").collect()
    forests = {}
    for size, n in sizes.items():
        x = [np.frombuffer(bytes(r["v"])) for r in sample if len(r["v"]) == size]
        forests[size] = plant(np.stack(x), n, similar=similar) if x else [{"splits": {}, "deep": {}, "seed": 3, "margin": 0.0}]

    def place(batches):
        for b in batches:
            blobs, cid, n, label = b.column(2).to_pylist(), b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            for size in sorted({len(v) for v in blobs}):
                at = np.flatnonzero([len(v) == size for v in blobs])
                row, code = leaves(np.stack([np.frombuffer(blobs[k]) for k in at]), forests[size])
                cut = np.searchsorted(row, np.arange(len(at) + 1))
                own = [code[cut[k] : cut[k + 1]].tobytes() for k in range(len(at))]
                yield pa.RecordBatch.from_arrays([pa.array(code), label.take(pa.array(at[row])), pa.array(np.full(len(row), size)), pa.array(cid[at[row]]), pa.array(n[at[row]]),
                                                  pa.array([blobs[k] for k in at[row]], pa.binary()), pa.array([own[k] for k in row], pa.binary())],
                                                 names=["code", "label", "size", "cid", "n", "v", "codes"])

    placed = land(classes.select("cid", "n", "v", "label").mapInArrow(place, "code long, label string, size long, cid long, n long, v binary, codes binary"), "vec-leaves")
    leaf = ["code", "label", "size"]
    held = placed.groupBy(*leaf).agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    dealt = block_pairs(placed.join(held, leaf), leaf, "cid", "held", BLOCK, ["cid", "n", "v", "codes"])

    def run(group: pa.Table) -> pa.Table:
        cid, n = group.column("cid").to_numpy(), group.column("n").to_numpy()
        x = np.stack([np.frombuffer(v.as_py()) for v in group.column("v")])
        codes = [np.frombuffer(c.as_py(), np.int64) for c in group.column("codes")]
        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        links, root = compare(cid, n, x, codes, group.column("side").to_numpy(), same, group.column("code")[0].as_py(), similar)
        keep = (links > 0) | (root != cid)
        return pa.table({"cid": cid[keep], "links": links[keep], "root": root[keep]})

    found = land(dealt.groupBy(*leaf, "i", "j").applyInArrow(run, "cid long, links long, root long"), "vec-found")
    comp = components(found.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = (classes.select("key", "cid", "n", "least").join(links, "cid", "left").join(comp, classes.cid == comp.node, "left")
              .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component"), "least"))
    joined = land(joined, "vec-joined")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = joined.join(least, "component").select("key", "n_links", "component_id")
    got = rows.select("id", "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return got.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
