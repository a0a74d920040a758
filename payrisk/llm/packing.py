"""Packing (operator 1): retrieval packing with a sharded BM25 index.

Documents are tokenised whole, each followed by a separator id.  Terms are pairs of neighbouring ids, keyed by the 64-bit pair
itself; their document frequencies count all documents and are joined in Spark.  A document's two least hashes of pairs (MinHash)
order the table, so texts that share words stand together; a range of that order is a task, cut into shards of bounded size.  Each
shard builds a BM25 inverted index of its documents, and all terms of a seed vote; documents of other shards are no candidates.  The first unused document is the seed; the index returns its unused neighbours, best first, and
they fill the window one after the other; without one the next unused document is the seed.  A document that doesn't fit is cut
and goes on in the next window, and an open window goes on in the next shard, so only a task's last window is padded.

Cases: null and empty texts are the separator alone; repeated rows and repeated or null ids are packed row by row; ties in
score go to the earlier document; an empty table gives an empty result; very long texts fill many windows; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import land, mix64, slices

WINDOW = 2048
SEPARATOR = 1
TERMS = 1 << 18
K1, B = 1.2, 0.75
#: None: all terms of a seed vote, no query is cut.
QUERY_TERMS = None
#: Characters in a part, on average, from which a text is cut at :data:`PARTS`: each part is a call.
PART_CHARS = 100
#: Terms in at least one of so many of a shard's documents are scored by a matrix product, for so many seeds at once.
COMMON, SEEDS = 8, 32
#: Weights are multiples of it, so a shard's scores (below 2^27) are exact sums, equal in any order.
GRAIN = 2.0**-26
SHARD_DOCS, SHARD_IDS = 2_048, 1_500_000
TASK_IDS = 3_000_000
#: Counts that a task holds before it sums those of equal pairs.
HELD_COUNTS = 1_000_000
#: Ids whose pairs are counted together.
BUCKET_IDS = 2_000_000
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Fixed value: how byte-level BPE files split a text before merging (possessive, so nothing is tried twice).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: The same for a text cut at :data:`PARTS`; without look-ahead it runs as an automaton.
PART_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: Before the last of several spaces that precede a word.  Spaces are Unicode's; Python's ``\s`` also has U+001C to U+001F.
PARTS = re.compile(r"(?<=[^\S\x1c-\x1f])(?=[^\S\x1c-\x1f][\S\x1c-\x1f])")


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of a byte-level BPE file whose ids follow its merges, so that the least id among the possible merges is the next
    merge; None for any other kind of file."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix") and not model.get("byte_fallback")
             and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True))
    if not plain:
        return None
    # byte-level files write printable bytes as themselves and the others, in order, as the characters from U+0100 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in set(shown))}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        return None
    return {bytes(char[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


class FileTokenizer:
    """Ids of whole texts by a ``tokenizers`` file.

    A byte-level BPE file is run by ``tiktoken`` with the file's own ranks (equal ids, a fraction of the time); texts that name one of
    the file's special tokens, and files of another kind, go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self.of_part = None
        if (ranks := byte_ranks(spec)) is not None:
            import tiktoken

            self.fast, self.of_part = (tiktoken.Encoding("file", pat_str=split, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
                                       for split in (SPLIT, PART_SPLIT))

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        parts = PARTS.split(text)
        if len(parts) == 1:
            return self.of_part(text)
        return self.fast(text) if len(text) < PART_CHARS * len(parts) else [x for part in parts for x in self.of_part(part)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(array(self.kind, self.ids(t)), self.kind) for t in texts]


_TOKENIZERS: dict[str, FileTokenizer] = {}


def tokenizer(path: str) -> FileTokenizer:
    """One per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = FileTokenizer(path)
    return _TOKENIZERS[path]


def term_pairs(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term) of each pair of neighbouring ids within a document."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    if len(flat) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = doc[1:] == doc[:-1]
    key = flat[:-1].astype(np.uint64) << np.uint64(32) | flat[1:].astype(np.uint64)
    return doc[1:][inside], (mix64(key[inside]) % np.uint64(TERMS)).astype(np.int64)


def _order_keys(doc: np.ndarray, term: np.ndarray, n: int) -> list[np.ndarray]:
    """Two least term hashes of each document (the largest number without a term)."""
    out = []
    for seed in (1, 2):
        key = np.full(n, np.iinfo(np.int64).max)
        if len(doc):
            h = (mix64(term.astype(np.uint64) + np.uint64(seed << 40)) >> np.uint64(1)).astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            key[doc[start]] = np.minimum.reduceat(h, start)
        out.append(key)
    return out


def tokenize(docs: DataFrame, path: str, separator: int = SEPARATOR) -> DataFrame:
    """Landed (uid, doc_id, n, ids, o1, o2) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, words = TaskContext.get().partitionId() << 33, tokenizer(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in slices(texts):
                ids = [np.append(x, np.array([separator], x.dtype)) for x in words.encode(texts[lo:hi])]
                n = np.array([len(x) for x in ids])
                o1, o2 = _order_keys(*term_pairs(np.concatenate(ids), n), hi - lo)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + hi - lo)), b.column(0).slice(lo, hi - lo), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary()),
                                                  pa.array(o1), pa.array(o2)], names=["uid", "doc_id", "n", "ids", "o1", "o2"])
                uid += hi - lo

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return land(src.mapInArrow(run, "uid long, doc_id long, n long, ids binary, o1 long, o2 long"), "pack-ids", "zstd")


def _ids(blobs: list[bytes], n: list[int]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.dtype(f"<u{len(x) // k}")) for x, k in zip(blobs, n)]


def pair_keys(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit key) of each pair of neighbouring ids within a document; different pairs have different keys."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    if len(flat) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = doc[1:] == doc[:-1]
    return doc[1:][inside], (flat[:-1].astype(np.uint64) << np.uint64(32) | flat[1:].astype(np.uint64))[inside]


def pair_counts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, document, count) of the distinct pairs of each document, ascending by key, then document.

    Where all ids have 16 bits, a pair and its document share one integer and one plain sort brings equal ones together."""
    lengths = np.array([len(x) for x in ids])
    flat = np.concatenate(ids)
    bits = max(len(ids) - 1, 1).bit_length()
    if flat.dtype.itemsize > 2 or bits > 32:
        doc, pair = pair_keys(flat, lengths)
        by = np.lexsort((doc, pair))
        doc, pair = doc[by], pair[by]
        first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])])) if len(pair) else np.zeros(0, np.int64)
        return pair[first], doc[first], np.diff(np.append(first, len(pair)))
    wide = flat.astype(np.uint64)
    doc = np.repeat(np.arange(len(ids), dtype=np.uint64), lengths)
    both = ((wide[:-1] << np.uint64(16) | wide[1:]) << np.uint64(bits) | doc[1:])[doc[1:] == doc[:-1]]
    both.sort()
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    pair, at = both[first] >> np.uint64(bits), (both[first] & np.uint64((1 << bits) - 1)).astype(np.int64)
    return pair >> np.uint64(16) << np.uint64(32) | pair & np.uint64(0xFFFF), at, np.diff(np.append(first, len(both)))


def starts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def packed(key: np.ndarray) -> bytes:
    """Keys of pairs; in half the bytes where both ids of all pairs have 16 bits."""
    if (key & np.uint64(0xFFFF0000FFFF0000)).any():
        return key.astype("<u8").tobytes()
    return (key >> np.uint64(16) | key & np.uint64(0xFFFF)).astype("<u4").tobytes()


def unpacked(blob: bytes, n: int) -> np.ndarray:
    """The ``n`` keys of a blob."""
    if len(blob) == 8 * n:
        return np.frombuffer(blob, "<u8")
    key = np.frombuffer(blob, "<u4").astype(np.uint64)
    return key >> np.uint64(16) << np.uint64(32) | key & np.uint64(0xFFFF)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    if len(key) and not (key & np.uint64(0xFFFF0000FFFF0000)).any() and int(n.max()) < 1 << 32:
        # a key and its count share one integer, so a plain sort does
        both = (key >> np.uint64(16) | key & np.uint64(0xFFFF)) << np.uint64(32) | n.astype(np.uint64)
        both.sort()
        key, n = both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = starts(key)
        key = key[first]
        return key >> np.uint64(16) << np.uint64(32) | key & np.uint64(0xFFFF), np.add.reduceat(n, first)
    key, at = np.unique(key, return_inverse=True)
    return key, np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)


def term_weights(ordered: DataFrame, docs: int, total: int) -> DataFrame:
    """(task, keys, idf): the pairs that more than one document of a task has, with their IDF over all documents.

    Each pair is counted where its documents stand; the counts meet by hash of the pair, and what a task asks for goes back to it.
    """
    buckets = np.uint64(total // BUCKET_IDS + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            key, n = _summed(keys, counts)
            bucket = (mix64(key) % buckets).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(bucket[by]) > 0])) if len(by) else np.zeros(0, np.int64)
            cuts = [by[a:b] for a, b in zip(first, [*first[1:], len(by)])]
            return pa.RecordBatch.from_arrays([pa.array(bucket[by[first]]), pa.array(np.full(len(first), task)), pa.array([packed(key[c]) for c in cuts], pa.binary()),
                                               pa.array([n[c].astype("<u4").tobytes() for c in cuts], pa.binary())], names=["bucket", "task", "keys", "counts"])

        task, keys, counts, held, kept = -1, [], [], 0, 0
        for b in batches:
            tasks, n, blobs = b.column(0).to_numpy(), b.column(1).to_pylist(), b.column(2).to_pylist()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(tasks)) + 1, [len(tasks)]])
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi > lo and tasks[lo] != task:
                    if keys:
                        yield out()
                    task, keys, counts, held, kept = tasks[lo], [], [], 0, 0
                for at in range(lo, hi, 500):
                    end = min(at + 500, hi)
                    pair, _, _ = pair_counts(_ids(blobs[at:end], n[at:end]))
                    first = starts(pair)
                    keys.append(pair[first])
                    counts.append(np.diff(np.append(first, len(pair))).astype(np.uint32))
                    held += len(first)
                    if held > 2 * kept + HELD_COUNTS:
                        key, n_held = _summed(keys, counts)
                        keys, counts, held, kept = [key], [n_held.astype(np.uint32)], len(key), len(key)
        if keys:
            yield out()

    def weigh(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        keys = [unpacked(x, len(n) // 4) for x, n in zip(rows["keys"].to_pylist(), rows["counts"].to_pylist())]
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), "<u4")
        flat, tasks = np.concatenate(keys), rows["task"].to_numpy()
        key, df = _summed([flat], [counts])
        idf = np.log1p((docs - df + 0.5) / (df + 0.5))
        edges = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
        if (tasks[1:] == tasks[:-1]).any():  # a task was read in parts
            tasks, rank = np.unique(tasks, return_inverse=True)
            both, place = np.unique(np.repeat(rank, np.diff(edges)) * len(key) + np.searchsorted(key, flat), return_inverse=True)
            flat, counts = key[both % len(key)], np.bincount(place, weights=counts)
            edges = np.searchsorted(both, np.arange(len(tasks) + 1) * len(key))
        kept = counts > 1
        edges, flat = np.concatenate([[0], np.cumsum(kept)])[edges], flat[kept]
        weight = idf[np.searchsorted(key, flat)].astype("<f8")
        cuts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
        return pa.table({"task": pa.array(tasks, pa.int64()), "keys": pa.array([flat[c].tobytes() for c in cuts], pa.binary()),
                         "idf": pa.array([weight[c].tobytes() for c in cuts], pa.binary())})

    rows = ordered.select("task", "n", "ids").mapInArrow(count, "bucket long, task long, keys binary, counts binary")
    return rows.groupBy("bucket").applyInArrow(weigh, "task long, keys binary, idf binary")


class Vocabulary:
    """Numbers the pairs of sorted ``keys``; other pairs, which one document of the task has at most, are left out."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def __call__(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, document, count), by term, then document."""
        pair, doc, tf = pair_counts(ids)
        if not len(self.keys) or not len(pair):
            return np.zeros(0, np.int64), doc[:0], tf[:0]
        first = starts(pair)
        at = np.minimum(np.searchsorted(self.keys, pair[first]), len(self.keys) - 1)
        at = np.repeat(np.where(self.keys[at] == pair[first], at, -1), np.diff(np.append(first, len(pair))))
        known = at >= 0
        return at[known], doc[known], tf[known]


def term_counts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, document, count) by hashed terms (:func:`term_pairs`), by term, then document."""
    doc, term = term_pairs(np.concatenate(ids), np.array([len(x) for x in ids]))
    key, tf = np.unique(term * len(ids) + doc, return_counts=True)
    return key // len(ids), key % len(ids), tf


class Shard:
    """BM25 inverted index of some documents; ``terms`` gives (term, document, count) of their ids, ``idf`` is by term."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float, terms: Callable = term_counts):
        n = np.array([len(x) for x in ids])
        term, doc, tf = terms(ids)
        run = np.diff(np.append(starts(term), len(term)))
        both = np.repeat(run > 1, run)  # a term that no other document of the shard has finds none
        term, self.doc, tf = term[both], doc[both], tf[both]
        norm = K1 * (1 - B + B * (n - 1) / max(mean, 1e-9))
        weight = np.ceil(idf[term] * tf * (K1 + 1) / (tf + norm[self.doc]) / GRAIN) * GRAIN
        size = run[run > 1]
        common = size * COMMON >= len(ids)
        dense = np.repeat(common, size)
        # common terms: a matrix (term, document); it is zero where the document has no such pair
        self.gives = np.zeros((int(common.sum()), len(ids)))
        self.gives[np.repeat(np.arange(len(self.gives)), size[common]), self.doc[dense]] = weight[dense]
        self.asks, self.ahead = np.ascontiguousarray(self.gives.T > 0), {}
        self.doc, self.weight, self.size = self.doc[~dense], weight[~dense], size[~common]
        self.start = np.cumsum(self.size) - self.size
        # each document's query: all its other terms that another document of the shard has too
        place = np.repeat(np.arange(len(self.size)), self.size)
        order = self.doc.astype(np.uint16) if len(ids) <= 1 << 16 else self.doc  # small numbers are sorted by counting
        place = place[np.argsort(order, kind="stable")]
        edges = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=len(ids)))])
        self.query = [place[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def scores(self, k: int, free: np.ndarray | None = None) -> np.ndarray:
        """BM25 of all documents for document k's query; ``free`` marks documents that may be asked for next."""
        if k not in self.ahead:
            seeds = [k] if free is None else [k, *(k + 1 + np.flatnonzero(free[k + 1 :])[: SEEDS - 1])]
            self.ahead = dict(zip(seeds, self.asks[seeds].astype(float) @ self.gives))
        common = self.ahead[k]
        if not len(self.query[k]):
            return common
        start, n = self.start[self.query[k]], self.size[self.query[k]]
        at = np.arange(int(n.sum())) + np.repeat(start - np.cumsum(n) + n, n)
        return common + np.bincount(self.doc[at], weights=self.weight[at], minlength=len(self.query))


class Packer:
    """Fills windows; pieces are (document, start, length, sequence, offset)."""

    def __init__(self, window: int, sequence: int):
        self.window, self.sequence, self.used = window, sequence, 0

    def place(self, k: int, n: int) -> list[tuple[int, int, int, int, int]]:
        out, start = [], 0
        while start < n:
            if self.used == self.window:
                self.sequence, self.used = self.sequence + 1, 0
            take = min(n - start, self.window - self.used)
            out.append((k, start, take, self.sequence, self.used))
            start, self.used = start + take, self.used + take
        return out

    def fill(self, ids: list[np.ndarray], idf: np.ndarray, mean: float, terms: Callable = term_counts) -> list[tuple[int, int, int, int, int]]:
        shard, free, pieces = Shard(ids, idf, mean, terms), np.ones(len(ids), bool), []
        for seed in range(len(ids)):
            if not free[seed]:
                continue
            free[seed] = False
            pieces += self.place(seed, len(ids[seed]))
            if self.used < self.window:
                scores, sequence = np.where(free, shard.scores(seed, free), 0.0), self.sequence
                while self.sequence == sequence and self.used < self.window and scores[best := int(scores.argmax())] > 0:
                    free[best], scores[best] = False, 0.0
                    pieces += self.place(best, len(ids[best]))
        return pieces


def pack(docs: DataFrame, path: str, window: int = WINDOW, separator: int = SEPARATOR) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (32-bit little-endian), doc_tokens, sequence_id, offset."""
    tokens = tokenize(docs, path, separator)
    rows, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    mean = (total - rows) / max(rows, 1)  # a document of n ids has n - 1 pairs
    ordered = tokens.repartitionByRange(total // TASK_IDS + 1, "o1", "o2", "uid").sortWithinPartitions("o1", "o2", "uid")
    ordered = land(ordered.select(F.monotonically_increasing_id().alias("place"), "doc_id", "n", "ids"), "pack-order", "zstd")
    ordered = ordered.withColumn("task", F.shiftright("place", 33))

    def run(mine: pa.Table, weights: pa.Table) -> pa.Table:
        parts = [SCHEMA.empty_table()]
        if not mine.num_rows:
            return parts[0]
        mine = mine.sort_by("place")
        packer = Packer(window, mine["task"][0].as_py() << 33)
        keys = np.frombuffer(b"".join(weights["keys"].to_pylist()), "<u8")
        by = np.argsort(keys)
        terms, idf = Vocabulary(keys[by]), np.frombuffer(b"".join(weights["idf"].to_pylist()), "<f8")[by]
        doc_id, ids, held = [], [], 0

        def out():
            got = packer.fill(ids, idf, mean, terms)
            k, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*got))
            blobs = [ids[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in got]
            return pa.Table.from_arrays([pa.array([doc_id[i] for i in k], pa.int64()), pa.array(start), pa.array(length), pa.array(blobs, pa.binary()),
                                         pa.array([len(ids[i]) for i in k], pa.int64()), pa.array(sequence), pa.array(offset)], schema=SCHEMA)

        for d, n, x in zip(mine["doc_id"].to_pylist(), mine["n"].to_pylist(), mine["ids"]):
            if ids and (len(ids) >= SHARD_DOCS or held + n > SHARD_IDS):
                parts.append(out())
                doc_id, ids, held = [], [], 0
            doc_id.append(d)
            ids += _ids([x.as_py()], [n])
            held += n
        parts.append(out())
        return pa.concat_tables(parts)

    weights = term_weights(ordered, rows, total)
    return ordered.groupBy("task").cogroup(weights.groupBy("task")).applyInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packing_query(docs: DataFrame, path: str | None = None) -> DataFrame:
    """op1: one row per piece; ids_crc32 is the digest of its ids."""
    got = pack(docs.select("doc_id", "text"), path or default_tokenizer())
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
