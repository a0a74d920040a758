import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from payrisk.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Top digest of ``nodes`` and each node's siblings (before, after), level by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, groups = [], []
        for lo in range(0, len(nodes), 16):
            run = nodes[lo : lo + 16]
            for k in range(len(run)):
                for leaf in owners[lo + k]:
                    paths[leaf].append((run[:k], run[k + 1 :]))
            up.append(sha(*run))
            groups.append([x for o in owners[lo : lo + 16] for x in o])
        nodes, owners = up, groups
    return nodes[0], paths


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, text, lang, source, n_chars)."""
    def leaf(i, text, lang, source, n):
        return sha(*map(framed, (i, source, lang, n, text)))

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        tops[s] = climb([leaf(*r) for r in by[s]])
    root, root_paths = climb([tops[s][0] for s in sources])
    out = []
    for s, upper in zip(sources, root_paths):
        for r, path in zip(by[s], tops[s][1]):
            path = path + upper
            at = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                at = leaf(r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            for left, right in path:
                at = sha(*left, at, *right)
            out.append((r[0], leaf(*r), tops[s][0], root, sha(*(x for a, b in path for x in a + b)), at, at == root))
    return sorted(out, key=str)


def check(docs, rows):
    got = merkle.manifest_query(docs(rows)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == plain([(*r, len(r[1] or "")) for r in rows])
    return got


def test_against_plain(spark, docs):
    """Run lengths around the fanout, a hot source, one-row sources, and more sources than one run holds."""
    rows = [(i, f"Text {i} ÀÉ" if i % 3 else None, "en", "hot") for i in range(700)]
    rows += [(1000 + i, "ABC abc", None, f"n{n}") for n in (1, 2, 15, 16, 17, 33, 256, 257) for i in range(n)]
    rows += [(5000 + i, "x" * i, "fr", f"s{i}é") for i in range(20)]
    got = check(docs, rows)
    assert any(r["verified"] for r in got) and not all(r["verified"] for r in got)


def test_odd_rows(spark, odd, docs):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in odd.collect()] + [(None, None, None, None), (-5, "Minus", "en", ""), (-5, "Minus", "en", "")]
    check(docs, rows)


def test_one_row_and_none(spark, docs):
    (r,) = check(docs, [(0, "A", "en", "s")])
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == sha()
    assert merkle.manifest_query(docs([])).collect() == []


@pytest.mark.parametrize("change", [("text", "'?'"), ("n_chars", "cast(null as long)"), ("lang", "''")])
def test_each_field_counts(spark, docs, change):
    one = docs([(1, "A", None, "s")])
    assert merkle.manifest_query(one).first()["leaf"] != merkle.manifest_query(one.withColumn(change[0], F.expr(change[1]))).first()["leaf"]


def test_partitions_and_order_do_not_matter(spark, docs):
    rows = [(i * 7 % 300, f"T{i % 40}", "en", "ab"[i % 5 == 0]) for i in range(600)]
    one = merkle.manifest_query(docs(rows).coalesce(1)).collect()
    assert sorted(map(str, one)) == sorted(map(str, merkle.manifest_query(docs(rows[::-1]).repartition(9)).collect()))


def test_other_fanout(spark, docs):
    rows = docs([(i, f"t{i}", "en", "s") for i in range(11)])
    got = merkle.manifest(rows, fanout=3)
    assert [len(r["path"]) for r in got.collect()] == [3] * 11
    assert got.filter(merkle.fold(F.col("leaf"), "path") == F.col("root")).count() == 11
