import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from payrisk.llm import chat, mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / w > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        full |= over


def test_mix_against_plain(spark, docs):
    rows = [(i, "w " * (1 + i * 7 % 23), None, s) for i, s in enumerate(["a"] * 4 + ["b"] * 90 + ["c"] * 30 + [None] * 20 + ["d"])]
    got = mixing.mixing_query(docs(rows)).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = plain_targets(sizes)
    source = {i: s for i, _, _, s in rows}
    taken = {s: 0 for s in sizes}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert sum(taken.values()) == sum(sizes.values())
    assert all(abs(taken[s] - want[s]) <= 23 for s in sizes)
    again = mixing.mixing_query(docs(rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    # finish times by hand
    queue = []
    for s in sizes:
        for e in range(3):
            at = e * sizes[s]
            for key, i, n in sorted((hashlib.md5(f"mix:{i}".encode()).hexdigest(), i, len(t.split())) for i, t, _, x in rows if x == s):
                at += n
                queue.append((at / want[s], ["a", "b", "c", "d", None].index(s), e, key, i, n))
    left, mine = sum(sizes.values()), {}
    for _, _, _, _, i, n in sorted(queue):
        mine[i] = mine.get(i, 0) + max(0, min(n, left))
        left -= n
    assert {r["doc_id"]: r["taken"] for r in got} == mine


def test_ranges_do_not_change_the_mix(spark, docs):
    sizes = docs([(i % 50, "w " * (i % 9), None, "ab"[i % 3 == 0]) for i in range(300)]).selectExpr("doc_id", "source", "size(split(trim(text), ' ')) as size")
    one = mixing.mix(sizes, rows_per_range=10**9).collect()
    many = mixing.mix(sizes, rows_per_range=2).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_mix_odd_rows(odd, docs):
    got = mixing.mixing_query(odd)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() == 10
    assert mixing.mixing_query(docs([])).count() == 0
    assert mixing.mixing_query(docs([(1, None, None, None), (2, "", None, "a")])).filter("taken <> 0 or target <> 0").count() == 0
    assert mixing.mixing_stage(odd).columns == odd.columns


CHAT = "pair_id long, side string, turn long, role string, text string, prompt string"


def test_stage_keeps_the_copies_of_rows_alike(docs):
    """Different texts without id, or with one id, and of one size: each has its own copies, and they are dealt apart."""
    rows = [(None if i % 2 else 7, f"text number w{i} here", "en", "s") for i in range(40)] + [(100 + i, "a b c d", "en", "r") for i in range(40)]
    df = docs(rows + [(500 + i, "x y z u", "en", "q") for i in range(200)])
    sizes = df.select("doc_id", "source", mixing.words().alias("size"), F.monotonically_increasing_id().alias("number"))
    out = [r["text"] for r in mixing.mixing_stage(df).collect()]
    plain = mixing.mix(sizes.drop("number")).filter("source = 's'").agg(F.sum("copies")).first()[0]
    assert plain % 40 and sum(t.startswith("text") for t in out) == plain
    got = mixing.mix(sizes).collect()
    assert len({r["number"] for r in got}) == len(got) == 280
    copies = [r["copies"] for r in got if r["source"] == "s"]
    assert len(copies) == 40
    assert sum(copies) == plain
    assert len(out) == sum(r["copies"] for r in got)


def test_pairs(spark):
    rows = [(1, "chosen", 0, "user", "hi", "p"), (1, "rejected", 0, "user", "hi", "p"), (1, "chosen", 1, "assistant", "yes", "p"), (1, "rejected", 1, "assistant", "nope", "p"),
            (1, "chosen", 1, "assistant", "yes", "p"), (2, "chosen", 0, "user", "same", "p"), (2, "rejected", 0, "user", "same", "p"),
            (3, "chosen", 0, None, None, "p"), (None, "rejected", None, "user", "x", "p")]
    got = {r["pair_id"]: r for r in chat.format_pairs(spark.createDataFrame(rows, CHAT)).collect()}
    r = got[1]
    assert (r["n_prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) == (1, "<|user|>\nhi\n", "<|assistant|>\nyes\n", "<|assistant|>\nnope\n")
    a, b = map(int, r["chosen_mask"].split("-"))
    assert r["chosen"][a:b] == "yes"
    assert got[2]["n_prompt_turns"] == 1 and got[2]["chosen"] == got[2]["rejected"] == ""
    assert got[3]["chosen"] == "<|unknown|>\n\n" and got[3]["rejected"] == "" and got[None]["rejected"] == "<|user|>\nx\n"
    assert chat.format_pairs(spark.createDataFrame([], CHAT)).count() == 0


def test_chat_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    q = chat.chat_query(spark.read.parquet(f"{d}/conversations.parquet"))
    want = con.execute(chat.SQL).fetchall()
    assert sorted(map(tuple, q.select(*[c[0] for c in con.description]).collect())) == sorted(want)


def test_rows_without_id_are_spread(spark, docs):
    rows = [(None, " ".join(["w"] * (i % 40 + 1)) + f" t{i}", "en", "a") for i in range(2_000)] + [(i, "one two three", "en", "b") for i in range(200)]
    first, again = (mixing.mixing_query(docs(r).repartition(n)).collect() for r, n in ((rows, 2), (rows[::-1], 5)))
    assert len(first) == 2_200 and sorted(map(str, first)) == sorted(map(str, again))
    total = sum(r["taken"] for r in first if r["doc_id"] is None)
    assert abs(total - next(r["target"] for r in first if r["doc_id"] is None)) <= 60
    con = duckdb.connect()
    con.register("documents", docs(rows).select("doc_id", "source", "text").toPandas().astype({"doc_id": "Int64"}))
    assert sorted(map(str, con.sql(mixing.SQL).fetchall())) == sorted(str(tuple(r)) for r in first)
