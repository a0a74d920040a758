import random
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from payrisk.llm import minhash, vecdup
from payrisk.llm.common import components


def bag(t):
    w = (t or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def brute(n, linked):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(a):
                if linked(a, b) and root[a] != root[b]:
                    lo, hi = sorted((root[a], root[b]))
                    root = [lo if r == hi else r for r in root]
                    changed = True
    return root


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(700, i) for i in range(701, 760)] + [(9, 9)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node, c in got.items():
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert c == min(seen)
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_are_unbiased():
    """Slots agree with the probability of the weighted Jaccard similarity, repeated shingles included."""
    rng = random.Random(1)
    for _ in range(6):
        words = [f"w{rng.randrange(40)}" for _ in range(400)] + ["z"] * rng.randrange(200)
        other = words[: rng.randrange(100, 400)] + [f"v{rng.randrange(40)}" for _ in range(rng.randrange(200))] + ["z"] * rng.randrange(100)
        texts = [" ".join(words), " ".join(other)]
        a, b = map(bag, texts)
        want = sum((a & b).values()) / sum((a | b).values())
        doc, key, count = minhash.bags(texts)
        assert count[doc == 0].sum() == sum(a.values()) and sorted(count[doc == 1]) == sorted(b.values())
        sig = minhash.signatures(doc, key, count, 2, slots=4000)
        assert abs((sig[0] == sig[1]).mean() - want) < 0.045


def make(rng, n):
    texts = [None, "", "  ", "one two", "one two", "a b c d e", "a b c d e", "a b c d f"]
    base = [[f"t{rng.randrange(3000)}" for _ in range(rng.choice([12, 60, 300]))] for _ in range(n)]
    for w in base:
        texts.append(" ".join(w))
        for _ in range(rng.randrange(4)):
            v = list(w)
            for _ in range(rng.randrange(1, 1 + max(1, len(v) // 60))):
                v[rng.randrange(len(v))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(v))
    chain = [f"c{i}" for i in range(200)]  # each near the next, ends far apart
    for k in range(8):
        texts.append(" ".join(chain[k * 8 : k * 8 + 120]))
    return texts


def test_near_duplicates_against_all_pairs(spark, docs):
    texts = make(random.Random(5), 40)
    bags = [bag(t) for t in texts]

    def linked(a, b):
        union = sum((bags[a] | bags[b]).values())
        return union > 0 and sum((bags[a] & bags[b]).values()) >= 0.8 * union

    root = brute(len(texts), linked)
    got = {r["doc_id"]: r for r in minhash.dedup_query(docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == root
    assert all(got[i]["kept"] == (root[i] == i) for i in got)


def test_later_steps_join_what_the_first_leaves(spark):
    """Bucket rows of two components whose members are alike: both steps propose the pair, in one block and across blocks."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**32, minhash.SLOTS, dtype=np.uint32)
    sigs = []
    for k in range(6):
        s = base.copy()
        s[10 + k : 20 + k] = k + 1
        sigs.append(s)
    bucket = int(minhash.band_keys(np.stack(sigs))[0, 1])
    keys = minhash.band_keys(np.stack(sigs))
    band = next(b for b in range(minhash.BANDS) if len(set(keys[:, b])) == 1)
    bucket = int(keys[0, band])
    rows = spark.createDataFrame([(bucket, i, n, i % 2, bytearray(s.tobytes())) for n in (6,) for i, s in enumerate(sigs)], "bucket long, cid long, n long, comp long, sig binary")
    star = {tuple(r) for r in minhash._nearest_to_all(rows).collect()}
    assert star and all(a % 2 != b % 2 for a, b in star)
    for n in (6, 5000):  # 5,000 claimed rows make several blocks
        found = [tuple(r) for r in minhash._still_plausible(rows.withColumn("n", rows.n * 0 + n)).collect()]
        want = {x for a in range(6) for b in range(a) if a % 2 != b % 2 and not (keys[a, :band] == keys[b, :band]).any() for x in (a, b)}
        assert {r[1] for r in found} == want and len(found) == len(want)


def test_overlaps_are_exact():
    texts = make(random.Random(9), 12)
    shared, size = minhash.overlaps(texts, columns=7)
    for i, a in enumerate(map(bag, texts)):
        assert size[i] == sum(a.values())
        for j, b in enumerate(map(bag, texts)):
            if i != j:
                assert shared[i, j] == sum((a & b).values())


def test_links_across_blocks(spark):
    """Members that only the last step can link: every one in a component of its own, several blocks a bucket."""
    texts = [t for t in make(random.Random(11), 25) if bag(t)]
    rows = spark.createDataFrame([(7, i, i) for i in range(len(texts))], "bucket long, cid long, comp long")
    held = spark.createDataFrame(list(enumerate(texts)), "cid long, text string")
    bags = [bag(t) for t in texts]
    root = brute(len(texts), lambda a, b: sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()))
    for most in (8, 1000):
        got = {r["node"]: r["component"] for r in components(minhash._links_across(rows, held, most)).collect()}
        assert [got.get(i, i) for i in range(len(texts))] == root


def test_odd_rows(odd, docs):
    got = minhash.dedup_query(odd)
    assert got.count() == 10 and minhash.dedup_query(docs([])).count() == 0
    kept = minhash.dedup_stage(odd)
    assert kept.columns == odd.columns and kept.count() == 9  # the two equal rows give one


VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("key", T.StringType())])


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:30] + rng.normal(size=(30, 16)) * 0.25, base[:10], base[:30] * 2]).astype(np.float32)
    label = [int(v) if v < 3 else None for v in rng.integers(0, 4, len(x))]
    rows = [(i, [float(c) for c in v], label[i], "k") for i, v in enumerate(x)]
    rows += [(900, None, 1, "k"), (901, [0.0] * 16, 1, "k"), (902, [None] + [1.0] * 15, 1, "k"), (903, [float("nan")] + [1.0] * 15, 1, "k"), (904, [1.0, 2.0], 1, "k"), (905, [], 1, "k")]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)

    def linked(a, b):
        return label[a] is not None and label[a] == label[b] and u[a] @ u[b] >= 0.93

    root = brute(len(x), linked)
    got = {r["vec_id"]: r for r in vecdup.near_vectors(spark.createDataFrame(rows, VEC)).collect()}
    for i in range(len(x)):
        assert got[i]["n_links"] == sum(linked(i, j) for j in range(len(x)) if j != i)
        assert got[i]["component_id"] == root[i] and got[i]["kept"] == (root[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))
    assert vecdup.near_vectors(spark.createDataFrame([], VEC)).count() == 0


def test_forest_recall_and_counting_once(monkeypatch):
    """Deep trees with spill: pairs at the threshold meet, and each is counted in one leaf only."""
    rng = np.random.default_rng(4)
    x = vecdup.unit(rng.normal(size=(4000, 32)))
    y = vecdup.unit(x + rng.normal(size=x.shape) * 0.38 / np.sqrt(32))  # cosine about 0.93
    near = (x * y).sum(axis=1) >= 0.93
    both = np.concatenate([x, y])
    forest = vecdup.plant(both, len(both), leaf_rows=100)
    row, code = vecdup.leaves(both, forest)
    of = np.split(code, np.searchsorted(row, np.arange(1, len(both))))
    assert np.mean([len(np.intersect1d(of[i], of[4000 + i])) > 0 for i in np.flatnonzero(near)]) > 0.95
    cid, n = np.arange(len(both)), np.ones(len(both), np.int64)
    total = np.zeros(len(both), np.int64)
    for leaf in np.unique(code):
        at = row[code == leaf]
        links, _ = vecdup.compare(cid[at], n[at], both[at], [of[k] for k in at], np.zeros(len(at), int), True, int(leaf), 0.93)
        total[at] += links
    s = both @ both.T >= 0.93
    np.fill_diagonal(s, False)
    met = np.array([[len(np.intersect1d(of[i], of[j])) > 0 for j in np.flatnonzero(s[i])] for i in range(0, 200)], dtype=object)
    assert all(total[i] == sum(met[i]) for i in range(200)) and (total <= s.sum(axis=1)).all()


def test_trees_grow_beyond_the_sample():
    rng = np.random.default_rng(6)
    x = vecdup.unit(rng.normal(size=(6000, 16)))
    near = vecdup.unit(x + rng.normal(size=x.shape) * 0.1 / 4)
    forest = vecdup.plant(x[:200], 6000, leaf_rows=100)
    assert forest[0]["deep"]
    row, code = vecdup.leaves(np.concatenate([x, near]), forest)
    _, held = np.unique(code, return_counts=True)
    assert np.median(held) < 600 and held.max() < 4000
    of = np.split(code, np.searchsorted(row, np.arange(1, 12000)))
    assert np.mean([len(np.intersect1d(of[i], of[6000 + i])) > 0 for i in range(0, 6000, 10)]) > 0.98
