import numpy as np
import pytest

from payrisk.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank long, key long"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], schema)


def good(v):
    return v is not None and None not in v and len(v) > 0 and np.isfinite(v).all() and np.any(v)


def plain(rows, k=20):
    """All (query row, rank, id, score), by comparing everything."""
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if good(v)]
    out = []
    for at, (i, q) in enumerate(rows):
        if i is not None and i % 20 == 0:
            near = sorted((-float(v @ q), j is None, j or 0) for n, (j, v) in enumerate(rows) if n != at and len(v) == len(q))[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(near)]
    return out


def listed(rows):
    return sorted(((q, r, str(v), round(s, 6)) for q, r, v, s in rows), key=str)


def test_small_tables_are_searched_whole(spark):
    """Nulls, zeros, non-finite components, other lengths, null and repeated ids, ties, vectors of very different lengths."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5) * 10.0 ** rng.integers(-2, 3)]) for i in range(150)]
    rows += [(200, None), (220, []), (240, [0.0] * 5), (260, [1.0, None, 1.0, 1.0, 1.0]), (280, [1.0, float("nan"), 0.0, 0.0, 0.0]), (300, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    rows += [(320 + i, [1.0, 1.0]) for i in range(30)] + [(400, [1.0, 1.0, 1.0])] + [(500, [1.0, 0.0, -0.0, 0.0, 2.0]), (500, [1.0, 0.0, 0.0, 0.0, 2.0]), (500, [2.0, 0.0, 0.0, 0.0, 1.0])]
    got = hnsw.neighbours_query(table(spark, rows).repartition(3))
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    assert listed(got.collect()) == listed(plain(rows))


def test_thousands_of_copies(spark):
    """A third of all rows equal: the smallest ids win the ties, and the other rows are still found."""
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.5, 0.25]) for i in range(3000)] + [(3000 + i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(1000)]
    got = hnsw.neighbours_query(table(spark, rows)).collect()
    want = plain(rows)
    assert {(q, r): round(s, 6) for q, r, _, s in got} == {(q, r): round(s, 6) for q, r, _, s in want}
    assert listed(r for r in got if r[0] < 3000) == listed(r for r in want if r[0] < 3000)


def test_nothing_and_one(spark):
    assert hnsw.neighbours_query(table(spark, [])).collect() == []
    assert hnsw.neighbours_query(table(spark, [(0, [0.0, 0.0]), (20, None)])).collect() == []
    assert hnsw.neighbours_query(table(spark, [(0, [1.0, 2.0])])).collect() == []


@pytest.mark.parametrize("groups", [hnsw.TASK_QUERIES, 10])
def test_shards_parts_and_groups(spark, monkeypatch, groups):
    """Several shards, vectors in double precision, graphs in many parts and searched by several tasks: recall against all pairs, exact scores."""
    monkeypatch.setattr(hnsw, "TASK_QUERIES", groups)
    monkeypatch.setattr(hnsw, "shard_rows", lambda rows, size: 900)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2500, 24)) * rng.uniform(0.5, 1.5, size=(2500, 1))
    got = hnsw.neighbours_query(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    q = np.arange(0, 2500, 20)
    scores = x[q] @ x.T
    scores[np.arange(len(q)), q] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    assert len(got) == want.size and np.allclose([r["score"] for r in got], [x[r["query_id"]] @ x[r["vec_id"]] for r in got], rtol=1e-12)
    hits = {(i, j) for i, near in zip(q, want) for j in near} & {(r["query_id"], r["vec_id"]) for r in got}
    assert len(hits) / want.size >= 0.95
    for i in q:
        mine = sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and all(a["score"] >= b["score"] for a, b in zip(mine, mine[1:]))


def test_graph_has_layers_and_reaches_every_node():
    x = hnsw.sphere(np.random.default_rng(4).normal(size=(5000, 16)).astype(np.float32))
    layers = hnsw.build(x)
    assert [len(links) for links in layers] == [20, 313, 5000]
    for links in layers:
        assert hnsw._reach(links).all() and (links < len(links)).all() and not (links == np.arange(len(links))[:, None]).any()
        for row in links[:50]:
            assert len(set(row[row >= 0])) == (row >= 0).sum()


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = hnsw.neighbours_query(rows).collect()
    ids, x = zip(*((r["vec_id"], r["embedding"]) for r in rows.collect()))
    ids, x = np.array(ids), np.array(x)
    hit = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        near = set(ids[np.lexsort((ids, -s))[:20]])
        hit += len(near & {r["vec_id"] for r in got if r["query_id"] == ids[q]})
    assert hit / (20 * (ids % 20 == 0).sum()) >= 0.98
