import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.llm import trie
from payrisk.llm.trie import key_at

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                      T.StructField("key", T.StringType()), T.StructField("depth", T.LongType()), T.StructField("n", T.LongType())])


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS)


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = own.get(base, [])[:h] + ts[h:]
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(cs) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    got = trie.trie_query(table(spark, rows).repartition(parts)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_random_conversations(spark):
    """Few words, so that edges are cut in many places, conversations end within edges, and many are equal."""
    rng = random.Random(5)
    rows = [(c, t, "user" if t % 2 else "bot", rng.choice(["a", "b", "é"]) if rng.random() < 0.4 else "same") for c in range(150) for t in range(rng.randint(1, 14))]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (2, 5, "user", "x" * 300_000), (2, 6, "user", "漢字"), (-7, 0, "u", "neg"), (-5, 0, "u", "base"),
            (3, 1, "ab", "c"), (4, 1, "a", "bc"), (8, 1, "only"[:1], "one")] + [(10 + i, 0, "user", "copy") for i in range(60)]
    check(spark, rows)


def test_a_caterpillar_and_a_long_chain(spark):
    """One branching per turn, and one conversation of 700 turns (ids whose own turns are all kept: h = 0)."""
    ids = [c for c in range(0, 4000, 5) if zlib.crc32(str(c).encode()) % 9 == 0][:9]
    rows = [(c, t, "u", "same" if t < k else f"own{k}") for k, c in enumerate(ids[:8]) for t in range(k + 3)]
    rows += [(ids[8], t, "u", "same" if t < 5 else str(t % 3)) for t in range(700)]
    check(spark, rows)


def test_nothing(spark):
    assert trie.trie_query(table(spark, [])).collect() == [] and trie.trie_query(table(spark, [(None, 1, "u", "t")])).collect() == []


def test_compacted_nodes_and_handles(spark):
    """Nodes stand at branchings and ends only; a handle is the prefix of two-fattest length; located depths are the deepest extents."""
    words = ["abcdefgh", "abcdefgh1", "abcdexy", "abcdexz", "q", "abc", "abcdefgh12345678"]
    lists = spark.createDataFrame([(i, [(c.encode(), 1) for c in w]) for i, w in enumerate(words)], "conv_id long, turns array<struct<digest:binary,bytes:long>>")
    convs = trie.keyed(lists).withColumn("key", key_at("keys", "m"))
    nodes = trie.insert(convs.select("key", "m", "keys", "cum")).cache()
    assert sorted((r["lo"], r["hi"]) for r in nodes.collect()) == sorted([(0, 3), (3, 5), (5, 8), (8, 9), (9, 16), (5, 6), (6, 7), (6, 7), (0, 1)])

    def fattest(lo, hi):
        return max(range(lo + 1, hi + 1), key=lambda x: x & -x)

    for lo, hi, f in nodes.select("lo", "hi", trie.two_fattest(F.col("lo"), F.col("hi"))).collect():
        assert f == fattest(lo, hi)
    asked = ["abcd", "abcdexyz", "abcdefgh1234", "zzz", "abcdefgh12345678"]
    lists = spark.createDataFrame([(i, [(c.encode(), 1) for c in w]) for i, w in enumerate(asked)], "conv_id long, turns array<struct<digest:binary,bytes:long>>")
    ways = trie.keyed(lists).withColumn("l", F.lit(0).cast("long")).select("conv_id", "m", "keys", "cum", "l")
    found = trie.exits(trie.locate(ways, nodes, 5), nodes)
    assert {r["conv_id"]: (r["l"], r["q"]) for r in found.collect()} == {0: (3, 4), 1: (7, 7), 2: (9, 12), 3: (0, 0), 4: (16, 16)}


@pytest.mark.parametrize("chunk", [1, 40, 4096])
def test_ids_are_hashed_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    members = spark.createDataFrame([(b"k%d" % (i % 3 == 0), i) for i in range(500)], "key binary, conv_id long").repartition(6)
    got = {bytes(r["key"]): r["sha256"] for r in trie.joined_ids(members).collect()}
    assert got == {b"k%d" % k: hashlib.sha256(",".join(str(i) for i in range(500) if (i % 3 == 0) == k).encode()).hexdigest() for k in (0, 1)}
