"""Approximate nearest neighbours (operator 12): a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors are one class, which keeps the K + 1 smallest of its rows: no other row of it can be among K neighbours.  Classes are dealt to
shards by hash.  A shard's graph has layers: all its classes, a sixteenth, a sixteenth of these and so on (in the order of their
hashes, but much longer vectors first); a layer begins as a copy of the one above and takes in the remaining nodes in batches, each linked to diverse near nodes that a beam
search from the layers above finds.  Layers are flat arrays of neighbour numbers, landed as rows of parts; a search task streams in a
shard's parts, then blocks of queries, so it holds one graph and one block.

Largest inner product becomes nearness by one more dimension that gives all of a shard's vectors one length; queries have zero there.
Scores returned are inner products of the original vectors in double precision.

Shards have 64 times the square root of the rows (up to a memory bound), so searches are rows^1.5, not rows^2.  Each query asks every shard;
one of up to four beams of classes is searched whole.

Cases: null or zero vectors, and those with null or non-finite components, take no part; vectors meet those of equal length only; a null id is
no query but can be found, after others of its score; repeated rows and ids are rows of their own; ties go to the smaller id; with
fewer candidates than K all are returned; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import land

K = 20
EVERY = 20
#: Links of a node in the lowest layer (half of it above), beam widths while building and searching, ratio of layers.
LINKS, BUILD_BEAM, BEAM, RATIO = 32, 64, 128, 16
#: Most bytes of one shard's vectors, nodes taken in at once, bytes of "seen" marks, queries a block, bytes of a landed part.
SHARD_BYTES, BATCH, SEEN_BYTES, BLOCK, PART_BYTES = 256 << 20, 512, 32 << 20, 256, 1 << 14
#: Queries that one search task of a shard gets at most, about.
TASK_QUERIES = 1_000_000


def shard_rows(rows: int, row_bytes: int) -> int:
    return max(1, min(max(1_024, int(64 * rows**0.5)), SHARD_BYTES // max(row_bytes, 1)))


def sphere(v: np.ndarray) -> np.ndarray:
    """float32 vectors of length one whose products order as those of ``v`` with any query."""
    v = v.astype(np.float64) / np.abs(v).max()
    square = (v * v).sum(axis=1)
    return np.hstack([v, np.sqrt(np.maximum(square.max() - square, 0))[:, None]]).astype(np.float32) / np.float32(np.sqrt(square.max()))


def by_length(v: np.ndarray) -> np.ndarray:
    """Order of nodes: by halving length, else as they come.  Long vectors have the largest products, so the upper layers hold them."""
    most = np.abs(v).max(axis=1).astype(np.float64)
    length = most * np.sqrt(((v / most[:, None].astype(v.dtype)).astype(np.float64) ** 2).sum(axis=1))
    return np.argsort(-np.floor(np.log2(length)), kind="stable")


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, width: int, entry: np.ndarray, opened: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores), best first and -1 padded, that a best-first search with that width finds from ``entry`` for every query."""
    b, rows = len(q), np.arange(len(q))
    seen = np.zeros((b, len(links)), np.int32)
    ids = np.full((b, width), -1, np.int32)
    score = np.full((b, width), -np.inf, np.float32)
    done = np.ones((b, width), bool)
    e = entry.shape[1]
    ids[:, :e], done[:, :e] = entry, entry < 0
    score[:, :e] = np.where(entry >= 0, np.einsum("bd,bed->be", q, x[entry]), -np.inf)
    seen[np.repeat(rows, e)[(entry >= 0).ravel()], entry[entry >= 0]] = 1
    act = rows
    while len(act):
        ready = ~done[act]
        ready &= ready.cumsum(axis=1) <= opened
        live = ready.any(axis=1)
        act, ready = act[live], ready[live]
        if not len(act):
            break
        r, c = np.nonzero(ready)
        done[act[r], c] = True
        near = links[ids[act[r], c]]
        own, node = np.repeat(act[r], links.shape[1]), near.ravel()
        fresh = (node >= 0) & (seen[own, node] == 0)
        own, node = own[fresh], node[fresh]
        stamp = np.arange(1, len(own) + 1, dtype=np.int32)
        seen[own, node] = stamp
        once = seen[own, node] == stamp  # two opened nodes may share a neighbour
        own, node = own[once], node[once]
        found = np.einsum("ij,ij->i", x[node], q[own])
        better = found > score[own, -1]
        own, node, found = own[better], node[better], found[better]
        if not len(own):
            continue
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))  # queries stand in order
        who, count = own[first], np.diff(np.append(first, len(own)))
        most = int(count.max())
        place = np.arange(len(own)) - np.repeat(first, count)
        at = np.repeat(np.arange(len(who)), count)
        more, more_score = np.full((len(who), most), -1, np.int32), np.full((len(who), most), -np.inf, np.float32)
        more[at, place], more_score[at, place] = node, found
        all_ids, all_score = np.hstack([ids[who], more]), np.hstack([score[who], more_score])
        all_done = np.hstack([done[who], more < 0])
        order = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
        line = np.arange(len(who))[:, None]
        ids[who], score[who], done[who] = all_ids[line, order], all_score[line, order], all_done[line, order]
    return ids, score


def diverse(x: np.ndarray, cand: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, best first and -1 padded, those nearer to the node than to one chosen before; then the best of the rest."""
    near = x[cand]
    pair = near @ near.transpose(0, 2, 1)
    keep = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        keep[:, j] = (cand[:, j] >= 0) & ~((pair[:, j, :] > score[:, j, None]) & keep).any(axis=1)
    rank = np.where(cand < 0, 2, np.where(keep, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    got = np.take_along_axis(cand, order, axis=1)
    return np.hstack([got, np.full((len(got), most - got.shape[1]), -1, got.dtype)]) if got.shape[1] < most else got


def _ranked(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct candidates of each node, best first."""
    cand = -np.sort(-cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    score = np.where(cand >= 0, np.einsum("bd,bcd->bc", x[nodes], x[cand]), -np.inf).astype(np.float32)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(cand, order, axis=1), np.take_along_axis(score, order, axis=1)


def _link(x: np.ndarray, links: np.ndarray, new: np.ndarray, cand: np.ndarray) -> None:
    """Links new nodes to diverse candidates, and these back."""
    width = links.shape[1]
    cand, score = _ranked(x, new, cand)
    links[new] = diverse(x, cand, score, width)
    to, back = links[new].ravel(), np.repeat(new, width)
    to, back = to[to >= 0], back[to >= 0]
    near = np.einsum("ij,ij->i", x[to], x[back])
    order = np.lexsort((-near, to))
    to, back = to[order], back[order]
    who, first, count = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(first, count)
    at = np.repeat(np.arange(len(who)), count)
    fit = place < width  # a node has no more links than that, so the nearest of those that ask are enough
    asks = np.full((len(who), width), -1, np.int32)
    asks[at[fit], place[fit]] = back[fit]
    for lo in range(0, len(who), BATCH):
        cand, score = _ranked(x, who[lo : lo + BATCH], np.hstack([links[who[lo : lo + BATCH]], asks[lo : lo + BATCH]]))
        links[who[lo : lo + BATCH]] = diverse(x, cand, score, width)


def descend(x: np.ndarray, upper: list[np.ndarray], q: np.ndarray, entries: int = 4) -> np.ndarray:
    """Entry nodes for a layer, found through those above it (``upper``: top first)."""
    entry = np.zeros((len(q), 1), np.int32)
    for links in upper:
        entry = beam(x, links, q, entries, entry)[0]
    return entry


def _reach(links: np.ndarray) -> np.ndarray:
    """Which nodes can be reached from node 0."""
    seen = np.zeros(len(links), bool)
    at = np.array([0])
    while len(at):
        seen[at] = True
        near = np.unique(links[at])
        near = near[near >= 0]
        at = near[~seen[near]]
    return seen


def build(x: np.ndarray) -> list[np.ndarray]:
    """Layers (top first) of neighbour numbers, -1 padded; the nodes of a layer are the first rows of ``x``."""
    sizes = [len(x)]
    while sizes[-1] > RATIO * RATIO:
        sizes.append(-(-sizes[-1] // RATIO))
    layers: list[np.ndarray] = []
    for size in reversed(sizes):
        links = np.full((size, LINKS if size == len(x) else LINKS // 2), -1, np.int32)
        done = 0
        if layers:
            done = len(layers[-1])
            links[:done, : layers[-1].shape[1]] = layers[-1]
        while done < size:
            step = min(BATCH, max(done, 64), max(16, SEEN_BYTES // (4 * size)), size - done)
            new = np.arange(done, done + step)
            same = x[new] @ x[new].T
            np.fill_diagonal(same, -np.inf)
            own = np.argsort(-same, axis=1)[:, : min(LINKS, step - 1)] + done if step > 1 else np.zeros((1, 0), np.int64)
            cand = own.astype(np.int32)
            if done:
                cand = np.hstack([cand, beam(x, links[:done], x[new], BUILD_BEAM, descend(x, layers, x[new]) if layers else np.zeros((step, 1), np.int32))[0]])
            _link(x, links, new, cand)
            done += step
        while not (seen := _reach(links)).all():  # pruning may cut a node off: it is linked from the nearest one that is reached
            lost = np.flatnonzero(~seen)[:BATCH]
            near = beam(x, links, x[lost], 8, np.zeros((len(lost), 1), np.int32))[0][:, 0]
            for u, v in zip(lost, near):
                free = np.flatnonzero(links[v] < 0)
                links = links if len(free) else np.hstack([links, np.full((size, 1), -1, np.int32)])
                links[v, free[0] if len(free) else -1] = u
        layers.append(links)
    return layers


def _pieces(data: np.ndarray, part_bytes: int) -> list[bytes]:
    step = max(1, part_bytes // max(data[:1].nbytes, 1))
    return [data[lo : lo + step].tobytes() for lo in range(0, len(data), step)]


PARTS = pa.schema([("bytes", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("width", pa.int32()), ("data", pa.binary())])
PARTS_SQL = "bytes long, shard long, kind int, part int, width int, data binary"
FOUND = "query_uid long, query_id long, vec_id long, uid long, score double"
#: Kinds of rows that a search task reads, in this order: vectors, members' numbers, members, layers from the top, queries.
VECTORS, COUNTS, MEMBERS, LAYER, QUERIES = 0, 1, 2, 3, 1_000


class Graph:
    """One shard, put together from its parts."""

    def __init__(self, parts: dict[int, list[bytes]], widths: dict[int, int], dtype: np.dtype, dim: int):
        def joined(kind, kind_type):
            return np.frombuffer(b"".join(parts[kind]), kind_type)

        self.v = joined(VECTORS, dtype).reshape(-1, dim)
        self.x = sphere(self.v)
        counts = joined(COUNTS, np.int32)
        self.end = np.cumsum(counts)
        self.start = self.end - counts
        self.members = joined(MEMBERS, np.int64).reshape(-1, 3)
        self.layers = [joined(kind, np.int32).reshape(-1, widths[kind]) for kind in sorted(k for k in parts if k >= LAYER)]

    def search(self, uid: np.ndarray, vec_id: np.ndarray, q: np.ndarray, k: int, width: int) -> dict[str, np.ndarray]:
        long = q.astype(np.float64)
        flat = np.hstack([long / np.abs(long).max(axis=1, keepdims=True), np.zeros((len(q), 1))]).astype(np.float32)
        step = max(16, SEEN_BYTES // (4 * len(self.v)))
        width = len(self.v) if len(self.v) <= 4 * width else width
        nodes = np.vstack([beam(self.x, self.layers[-1], flat[lo : lo + step], max(width, k + 1), descend(self.x, self.layers[:-1], flat[lo : lo + step]))[0] for lo in range(0, len(q), step)])
        out: list[tuple] = []
        for i, found in enumerate(nodes):
            found = found[found >= 0]
            score = self.v[found].astype(np.float64) @ long[i]
            n = self.end[found] - self.start[found]
            at = np.arange(int(n.sum())) + np.repeat(self.start[found] - np.cumsum(n) + n, n)
            none, ids, uids = self.members[at].T
            score = np.repeat(score, n)
            other = uids != uid[i]
            order = np.lexsort((uids, ids, none, -score))
            order = order[other[order]][:k]
            out.append((np.full(len(order), uid[i]), np.full(len(order), vec_id[i]), ids[order], none[order], uids[order], score[order]))
        cols = [np.concatenate(c) for c in zip(*out)]
        return {"query_uid": pa.array(cols[0]), "query_id": pa.array(cols[1]), "vec_id": pa.array(cols[2], mask=cols[3] > 0), "uid": pa.array(cols[4]), "score": pa.array(cols[5])}


def neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", width: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``every``."""
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    dtype = np.dtype(np.float32 if kind == "float" else np.float64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blobs = []
            for v in b.column(1).to_pylist():
                v = np.array(v if v and None not in v else [], dtype) + dtype.type(0)  # no negative zero
                blobs.append(v.tobytes() if np.isfinite(v).all() and v.any() else None)
            keys = [hashlib.md5(v, usedforsecurity=False).digest() if v else None for v in blobs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(v or b"") for v in blobs], pa.int64()), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], names=["id", "bytes", "key", "v"])

    values = F.col(vector_col).cast(f"array<{'float' if kind == 'float' else 'double'}>").alias("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), values).mapInArrow(read, "id long, bytes long, key binary, v binary").filter("key is not null")
    rows = land(rows.withColumn("uid", F.monotonically_increasing_id()), "hnsw-rows")
    # only the k + 1 least members of a class can be anyone's neighbours; a hot class is cut down before the shuffle
    least = Window.partitionBy("bytes", "key").orderBy(F.col("id").asc_nulls_last(), "uid")
    kept = rows.withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= k + 1)
    classes = land(kept.groupBy("bytes", "key").agg(F.first("v").alias("v"), F.sort_array(F.collect_list(F.struct("nth", "id", "uid"))).alias("members")), "hnsw-classes")
    held = {r["bytes"]: r["n"] for r in classes.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per vector length
    if not held:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = {size: -(-n // shard_rows(n, size)) for size, n in held.items()}
    shards_of = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in shards.items() for x in pair]), F.col("bytes"))

    def grow(keys: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        v = np.frombuffer(b"".join(rows["v"].to_pylist()), dtype).reshape(rows.num_rows, -1)
        order = by_length(v)
        v, rows = v[order], rows.take(pa.array(order))
        members = rows["members"].combine_chunks()
        flat = members.flatten()
        ids = flat.field("id")
        triples = np.stack([ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), flat.field("uid").to_numpy()], axis=1).astype(np.int64)
        layers = build(sphere(v))
        data = {VECTORS: v, COUNTS: members.value_lengths().to_numpy().astype(np.int32), MEMBERS: triples} | {LAYER + i: x for i, x in enumerate(layers)}
        out = [(kind, part, x.shape[1] if x.ndim > 1 else 1, piece) for kind, x in data.items() for part, piece in enumerate(_pieces(x, PART_BYTES))]
        kind, part, wide, piece = zip(*out)
        return pa.table([pa.array([keys[0].as_py()] * len(out), pa.int64()), pa.array([keys[1].as_py()] * len(out), pa.int64()), pa.array(kind, pa.int32()), pa.array(part, pa.int32()),
                         pa.array(wide, pa.int32()), pa.array(piece, pa.binary())], schema=PARTS)

    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("key"), shards_of))
    graph = land(dealt.groupBy("bytes", "shard").applyInArrow(grow, PARTS_SQL), "hnsw-graph")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column(0).to_numpy()
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                for lo in range(0, len(mine), BLOCK):
                    got = b.take(pa.array(mine[lo : lo + BLOCK]))
                    ids = np.stack([got.column(1).to_numpy(), got.column(2).to_numpy()], axis=1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([int(size)]), pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes() + b"".join(got.column(3).to_pylist())], pa.binary())], names=["bytes", "width", "data"])

    asked = rows.filter(F.col("id") % every == 0).select("bytes", "uid", "id", "v")
    asked = land(asked.mapInArrow(pack, "bytes long, width int, data binary").withColumn("block", F.monotonically_increasing_id()), "hnsw-queries")
    queries = asked.agg(F.sum("width")).first()[0] or 0
    groups = -(-queries // TASK_QUERIES) or 1
    blocks = asked.select("bytes", F.explode(F.sequence(F.lit(0).cast("long"), shards_of - 1)).alias("shard"), F.lit(QUERIES).alias("kind"), F.lit(0).alias("part"), "width", "data",
                          F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"))
    copies = graph.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"))
    slot = ["bytes", "shard", "group"]
    met = copies.unionByName(blocks).select(*slot, "kind", "part", "width", "data").repartition(*slot).sortWithinPartitions(*slot, "kind", "part")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, widths, held = None, {}, {}, None
        for b in batches:
            for *here, kind, _, wide, data in zip(*(c.to_pylist() for c in b.columns)):
                if here != at:
                    at, parts, widths, held = here, {}, {}, None
                if kind != QUERIES:
                    parts.setdefault(kind, []).append(data)
                    widths[kind] = wide
                    continue
                if held is None:
                    held, parts = Graph(parts, widths, dtype, here[0] // dtype.itemsize), {}
                ids = np.frombuffer(data[: 16 * wide], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict(held.search(ids[:, 0], ids[:, 1], np.frombuffer(data[16 * wide :], dtype).reshape(wide, -1), k, width))

    found = met.mapInArrow(ask, FOUND)
    best = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours_query(vectors: DataFrame) -> DataFrame:
    """op12: the 20 rows of largest inner product for every row whose vec_id is divisible by 20."""
    return neighbours(vectors)
