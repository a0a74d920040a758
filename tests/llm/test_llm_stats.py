import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from payrisk.llm import quality, rules
from payrisk.llm.textstats import stats

TEXTS = [None, "", " \n ", "a b c a b c", "x\nx\n\nx y\nx", "# $a <b>", "é\x0bü\x0c漢 a b", "one two three four\none two three five\n", "A" * 5000,
         "p q r p q r s p q", "t\n" * 40]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum((text or "").count(s) for s in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def test_counts_equal_plain_ones():
    got = stats(TEXTS)
    for i, t in enumerate(TEXTS):
        assert {k: int(got[k][i]) for k in plain(t)} == plain(t)
    assert all(np.isfinite(v).all() for v in got.values())


def test_isotonic_pools():
    n, pos = np.array([0, 10, 10, 0, 10, 10.0]), np.array([0, 2, 1, 0, 5, 9.0])
    curve = quality.pool(n, pos, 0.5)
    assert (np.diff(curve) >= 0).all() and abs(curve[1] - curve[2]) < 1e-9 and curve[5] > 0.8


def test_rules_find_a_conjunction(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (3000, 4))
    bad = (x[:, 1] > 0.7) & (x[:, 2] <= 0.3)
    found = rules.learn(x, bad, ["a", "b", "c", "d"])
    assert found and {c[0] for r in found for c in r.conditions} >= {"b", "c"}
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[:400])], "i int, a double, b double, c double, d double")
    got = {r["i"]: r["kept"] for r in df.select("i", rules.verdict(found).alias("kept")).collect()}
    assert np.mean([got[i] != bad[i] for i in range(400)]) > 0.97
    assert rules.learn(x, np.zeros(3000, bool), list("abcd")) == []
    assert spark.range(1).select(rules.verdict([])).first()[0] is True


def test_query_on_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for lab in (labels, none):
        got = rules.rules_query(odd, lab).collect()
        assert len(got) == 10 and all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4))
        assert [r["base_failed"] for r in got if r["doc_id"] == 6] == [True]
        q = quality.quality_query(odd, lab)
        assert q.columns == ["doc_id", "held_out", "score", "predicted"]
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in q.collect()) and q.count() == 10
    assert rules.rules_query(docs([]), labels).count() == 0 and quality.quality_query(docs([]), labels).count() == 0


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.1"
    docs_, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality_query(docs_, labels).filter("held_out").join(labels, "doc_id")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.97
    kept = rules.rules_query(docs_, labels).filter("not base_failed").join(labels, "doc_id")
    assert kept.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0] > 0.97
