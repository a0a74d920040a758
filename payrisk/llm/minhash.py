"""MinHash near-dedup (operator 9): BagMinHash signatures, banding, exact multiset overlap, components.

A text is a bag of five-word shingles (words are runs of non-white-space).  For every shingle the weight axis is cut into dyadic
intervals (0,1], (1,2], (2,4], ...; each carries a Poisson process of its own, seeded by shingle and interval, whose points have a
time, a weight level and a slot.  A text takes the points at levels up to the shingle's count; the first time in each slot is the
signature, so two texts agree in a slot with probability equal to their weighted Jaccard similarity.  Only points
before a bound that fills all slots are drawn; a text with a slot left empty is drawn again with a doubled bound.

Equal texts form one class.  Classes that agree in a band are candidates, and a pair counts after its bags' exact similarity is
0.8 or more.  First every class is compared with its bucket's least one; then, in buckets that still hold several
components, with the member nearest to all others; then all members of such a bucket that have a partner in another
component with 0.65 or more of the slots in common, block by block where they stand.  So no bucket's pairs are
emitted, and none that could join two components is left out.

Cases: null texts and texts without a word are near nothing, each stays alone; a text under five words is one shingle; repeated rows
are copies (of rows equal in id and text, one is kept); an empty table gives an empty result; very long texts are
shingled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import block_pairs, components, land, mix64, slices, word_hashes, words_of

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 5
SLOTS = BANDS * ROWS
#: Share of agreeing slots below which a pair of similarity 0.8 lies with a chance of about 1 in 50,000.
PLAUSIBLE = 0.65
BLOCK = 1024
_G = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), sorted by text and hash."""
    c, starts, ends, of, _ = words_of(texts)
    h = word_hashes(c, starts, ends)
    n = np.bincount(of, minlength=len(texts))
    first = np.cumsum(n) - n
    windows = np.maximum(n - size + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), windows)
    at = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    length = np.minimum(n, size)[doc]
    key = length.astype(np.uint64)
    for i in range(size):
        here = np.minimum(at + i, max(len(h) - 1, 0))
        key = np.where(i < length, mix64(key * _G + h[here]) if len(h) else key, key)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    return doc[start], key[start], np.diff(np.concatenate([start, [len(key)]]))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((mix64(x) >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """[n, slots] 32-bit signature of every bag; texts without a shingle have zeros."""
    total = np.bincount(doc, weights=count, minlength=n)
    first = np.full(n * slots, np.inf)
    todo, reach = np.flatnonzero(total > 0), (np.log(slots) + 4.0) / np.maximum(total, 1)
    # dyadic weight intervals below each count
    levels = 1 + np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)
    row = np.repeat(np.arange(len(key)), levels)
    k = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(k == 0, 0, 1 << np.maximum(k - 1, 0))
    width = np.maximum(low, 1)
    d0, w0 = doc[row], count[row]
    seed = mix64(key[row] ^ mix64((k + 1).astype(np.uint64) * _G))
    while len(todo):
        open_ = np.zeros(n, bool)
        open_[todo] = True
        at = np.flatnonzero(open_[d0])
        time, j = np.zeros(len(at)), 0
        while len(at):
            s = seed[at] + np.uint64((3 * j + 1) * int(_G) % 2**64)
            time = time - np.log(_uniform(s)) / (slots * width[at])
            live = time <= reach[d0[at]]
            at, time, s = at[live], time[live], s[live]
            level = low[at] + 1 + (_uniform(s + _G) * width[at]).astype(np.int64)
            ok = level <= w0[at]
            slot = (mix64(s[ok] + _G + _G) % np.uint64(slots)).astype(np.int64)
            np.minimum.at(first, d0[at][ok] * slots + slot, time[ok])
            j += 1
        empty = ~np.isfinite(first.reshape(n, slots)[todo]).all(axis=1)
        todo = todo[empty]
        reach[todo] *= 2
    out = (mix64(first.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).reshape(n, slots)
    out[total == 0] = 0
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """[n, BANDS] 64-bit key of each band, the band's number included."""
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), 1))
    for i in range(ROWS):
        key = mix64(key * _G + sig[:, i::ROWS].astype(np.uint64))
    return key.view(np.int64)


def _key(text):
    return F.md5(text.cast("binary"))


def sign(docs: DataFrame) -> DataFrame:
    """Landed (uid, doc_id, key, sig) of every row: uid numbers rows, key is the text's digest, sig null without a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            texts = b.column(2).to_pylist()
            for lo, hi in slices(texts):
                part = texts[lo:hi]
                doc, key, count = bags(part)
                sig = signatures(doc, key, count, len(part))
                has = np.bincount(doc, minlength=len(part)) > 0
                blobs = [s.tobytes() if ok else None for s, ok in zip(sig, has)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + hi - lo)), b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                                                  pa.array(blobs, pa.binary())], names=["uid", "doc_id", "key", "sig"])
                uid += hi - lo

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    return land(src.mapInArrow(run, "uid long, doc_id long, key string, sig binary"), "bag-sigs")


def _buckets(classes: DataFrame) -> DataFrame:
    """Landed (bucket, cid, least) of buckets with two classes or more."""
    def run(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(x.as_py() for x in b.column(1)), np.uint32).reshape(-1, SLOTS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(sig).ravel()), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], names=["bucket", "cid"])

    rows = classes.select("cid", "sig").mapInArrow(run, "bucket long, cid long")
    shared = rows.groupBy("bucket").agg(F.min("cid").alias("least"), F.max("cid").alias("most"), F.count(F.lit(1)).alias("n")).filter("least <> most")
    return land(rows.join(shared.select("bucket", "least", "n"), "bucket"), "bag-buckets")


def verify(pairs: DataFrame, texts: DataFrame, most: int = 128) -> DataFrame:
    """Those of ``pairs(a, b)`` whose bags have similarity 0.8 or more, by exact counts.

    A centre b and up to about ``most`` of its partners meet in one group; more partners make more groups.
    """
    count = pairs.groupBy("b").agg((F.count(F.lit(1)) / most + 1).cast("long").alias("blocks"))
    dealt = land(pairs.join(count, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).alias("block")), "bag-pairs")
    members = dealt.join(texts, dealt.a == texts.cid).select("b", "block", "a", "text")
    centres = dealt.select("b", "block").distinct().join(texts, F.col("b") == texts.cid).select("b", "block", F.col("b").alias("a"), "text")

    def run(group: pa.Table) -> pa.Table:
        ids, b, texts_ = group.column("a").to_numpy(), group.column("b")[0].as_py(), group.column("text").to_pylist()
        centre = int(np.flatnonzero(ids == b)[0])
        _, key, count = bags([texts_[centre]])
        hits = []
        for lo, hi in slices(texts_):
            doc, k, c = bags(texts_[lo:hi])
            at = np.minimum(np.searchsorted(key, k), len(key) - 1)
            both = np.bincount(doc, weights=np.where(key[at] == k, np.minimum(c, count[at]), 0), minlength=hi - lo)
            union = np.bincount(doc, weights=c, minlength=hi - lo) + count.sum() - both
            hits.append(ids[lo:hi][both >= SIMILAR * union])
        a = np.concatenate(hits)
        a = a[a != b]
        return pa.table({"a": a, "b": np.full(len(a), b)})

    return land(members.unionByName(centres).groupBy("b", "block").applyInArrow(run, "a long, b long"), "bag-links")


def _mixed(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """Bucket rows with their component, of buckets that hold several components."""
    rows = buckets.join(comp, buckets.cid == comp.node, "left").select("bucket", "cid", "n", F.coalesce("component", "cid").alias("comp"))
    several = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("bucket")
    return rows.join(several, "bucket")


def _nearest_to_all(rows: DataFrame) -> DataFrame:
    """Pairs of each member with the one whose slots are most often the common ones, block by block of a bucket."""
    def run(group: pa.Table) -> pa.Table:
        cid, comp = group.column("cid").to_numpy(), group.column("comp").to_numpy()
        sig = np.frombuffer(b"".join(x.as_py() for x in group.column("sig")), np.uint32).reshape(-1, SLOTS)
        if len(cid) <= 32:  # agreements with all others, summed
            agree = (sig[:, None] == sig[None]).sum(axis=(1, 2))
        else:  # slots that hold the commonest value
            agree = np.zeros(len(cid), np.int64)
            for s in range(SLOTS):
                _, at, n = np.unique(sig[:, s], return_inverse=True, return_counts=True)
                agree += at == n.argmax()
        m = int(np.lexsort((cid, -agree))[0])
        ok = (comp != comp[m]) & ((sig == sig[m]).mean(axis=1) >= PLAUSIBLE)
        return pa.table({"a": cid[ok], "b": np.full(int(ok.sum()), cid[m])})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("cid"), (F.col("n") / BLOCK + 1).cast("long")))
    return dealt.groupBy("bucket", "block").applyInArrow(run, "a long, b long").distinct()


def _still_plausible(rows: DataFrame) -> DataFrame:
    """(bucket, cid, comp) of members with a plausible partner of another component, by pairs of blocks.

    A pair counts in its first common band only.  Members come out, not pairs.
    """
    def run(group: pa.Table) -> pa.Table:
        cid, comp = group.column("cid").to_numpy(), group.column("comp").to_numpy()
        side, bucket = group.column("side").to_numpy(), group.column("bucket")[0].as_py()
        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        sig = np.frombuffer(b"".join(x.as_py() for x in group.column("sig")), np.uint32).reshape(-1, SLOTS)
        keys = band_keys(sig)
        band = int(np.flatnonzero(keys[0] == bucket)[0])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        hit = np.zeros(len(cid), bool)
        for x in left:
            r = right[comp[right] != comp[x]]
            r = r[(sig[r] == sig[x]).mean(axis=1) >= PLAUSIBLE]
            r = r[~(keys[r, :band] == keys[x, :band]).any(axis=1)]
            hit[r] = True
            hit[x] |= len(r) > 0
        return pa.table({"bucket": np.full(int(hit.sum()), bucket), "cid": cid[hit], "comp": comp[hit]})

    spread = block_pairs(rows, ["bucket"], "cid", "n", BLOCK, ["cid", "comp", "sig"])
    return spread.groupBy("bucket", "i", "j").applyInArrow(run, "bucket long, cid long, comp long").distinct()


def overlaps(texts: list, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """([n, n] shared shingles counted with their multiplicity, [n] bag sizes)."""
    n = len(texts)
    parts = [bags(texts[lo:hi]) for lo, hi in slices(texts)]
    doc = np.concatenate([d + lo for (d, _, _), (lo, _) in zip(parts, slices(texts))])
    key, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    size = np.bincount(doc, weights=count, minlength=n)
    # the k-th occurrence of a shingle is an element of its own: shared elements are the minima of the counts
    row = np.repeat(np.arange(len(doc)), count)
    kth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    _, element, held = np.unique(mix64(key[row] + kth.astype(np.uint64) * _G), return_inverse=True, return_counts=True)
    doc, keep = doc[row], held[element] > 1
    doc, element = doc[keep], np.unique(element[keep], return_inverse=True)[1]
    order = np.argsort(element, kind="stable")
    doc, element = doc[order], element[order]
    shared = np.zeros((n, n), np.float32)
    for lo in range(0, int(element[-1]) + 1 if len(element) else 0, columns):
        a, b = np.searchsorted(element, [lo, lo + columns])
        z = np.zeros((n, columns), np.float32)
        z[doc[a:b], element[a:b] - lo] = 1
        shared += z @ z.T
    return shared, size


def _links_across(members: DataFrame, texts: DataFrame, most: int = 128) -> DataFrame:
    """Landed links (a, b) between different components: bags of all members of a bucket are compared, block by block, where they
    stand; a block emits each member's least partner reachable in it, never its pairs."""
    members = land(members, "bag-members")
    held = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"))
    rows = members.join(held, "bucket").join(texts, "cid")

    def run(group: pa.Table) -> pa.Table:
        cid, comp, side = (group.column(c).to_numpy() for c in ("cid", "comp", "side"))
        shared, size = overlaps(group.column("text").to_pylist())
        near = shared >= SIMILAR * (size[:, None] + size[None] - shared)
        near &= comp[:, None] != comp[None]
        if group.column("i")[0].as_py() != group.column("j")[0].as_py():
            near &= side[:, None] != side[None]
        root, before = cid.copy(), None
        while before is None or (root != before).any():
            before = root
            root = np.minimum(before, np.where(near, before[None], np.iinfo(np.int64).max).min(axis=1))
        return pa.table({"a": cid[root != cid], "b": root[root != cid]})

    spread = block_pairs(rows, ["bucket"], "cid", "held", most, ["cid", "comp", "text"])
    return land(spread.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long").distinct(), "bag-across")


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): landed (uid, doc_id, key) of every row, and (key, component, rep_uid, rep_key, rep_doc) of every text."""
    signed = sign(docs)
    classes = land(signed.filter("sig is not null").groupBy("key").agg(F.min("uid").alias("cid"), F.first("sig").alias("sig")), "bag-classes")
    buckets = _buckets(classes)
    in_bucket = buckets.select("cid").distinct()
    wanted = land(classes.join(in_bucket, "cid", "left_semi").select("cid", "key", "sig"), "bag-wanted")
    texts = land(docs.select(_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text")).join(wanted.select("cid", "key"), "key")
                 .groupBy("cid").agg(F.first("text").alias("text")), "bag-texts")
    sigs = wanted.select("cid", "sig")
    links = verify(buckets.filter("cid <> least").select(F.col("cid").alias("a"), F.col("least").alias("b")).distinct(), texts)
    comp = components(links)
    for step in (lambda rows: verify(_nearest_to_all(rows), texts), lambda rows: _links_across(_still_plausible(rows), texts)):
        rows = land(_mixed(buckets, comp).join(sigs, "cid"), "bag-mixed")
        if rows.isEmpty():
            break
        known = comp.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        comp = components(known.unionByName(step(rows)))
    member = classes.join(comp, classes.cid == comp.node, "left").select("key", F.coalesce("component", "cid").alias("component"))
    rows = signed.select("uid", "doc_id", "key", F.col("sig").isNull().alias("alone"))
    rows = rows.join(member, "key", "left").select("uid", "doc_id", "key", F.when(F.col("alone"), F.col("uid")).otherwise(F.col("component")).alias("component"))
    rows = land(rows, "bag-rows")
    reps = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "key")).alias("rep"))
    return rows, land(reps.select("component", F.col("rep.uid").alias("rep_uid"), F.col("rep.doc_id").alias("rep_doc"), F.col("rep.key").alias("rep_key")), "bag-reps")


def dedup_query(docs: DataFrame) -> DataFrame:
    """op9: doc_id, component_id (least doc_id of its near-duplicate group), kept (one row of each group) for all documents."""
    rows, reps = near_duplicates(docs)
    return rows.join(reps, "component").select("doc_id", F.col("rep_doc").alias("component_id"), (F.col("uid") == F.col("rep_uid")).alias("kept"))


def dedup_stage(docs: DataFrame) -> DataFrame:
    """Pipeline: one document of each group stays; texts without a word stay."""
    _, reps = near_duplicates(docs)
    keep = reps.select("rep_doc", "rep_key").distinct()
    rows = docs.select(_key(F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("id"), F.struct("*").alias("row"))
    empty = F.col("row.text").isNull() | ~F.col("row.text").rlike(r"[^\x20\x09-\x0D]")
    one = rows.filter(~empty).groupBy("key", "id").agg(F.first("row").alias("row"))
    on = (F.col("key") == F.col("rep_key")) & F.col("id").eqNullSafe(F.col("rep_doc"))
    return one.join(keep, on, "left_semi").select("row.*").unionByName(rows.filter(empty).select("row.*"))
