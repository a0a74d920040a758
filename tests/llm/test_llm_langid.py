import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from payrisk.llm import langid


def brute_viterbi(scores, penalty):
    """Every sequence's best end by the definition, one word at a time."""
    n, k = scores.shape
    v, back = scores[0].astype(float).copy(), []
    for t in range(1, n):
        step = [[v[a] - (penalty if a != b else 0) for a in range(k)] for b in range(k)]
        back.append([int(np.argmax(s)) for s in step])
        v = np.array([max(s) for s in step]) + scores[t]
    return max(v)


def path_value(scores, path, penalty):
    return sum(scores[t, p] - (penalty if t and p != path[t - 1] else 0) for t, p in enumerate(path))


def test_path_is_optimal():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 0, 7, 30, 3, 12])
    scores = rng.normal(0, 4, (int(lengths.sum()), 3)).astype(np.float32)
    of = np.repeat(np.arange(len(lengths)), lengths)
    for penalty in (0.5, 3.0, 40.0):
        path = langid.best_path(scores, lengths, of, penalty)
        for d in np.flatnonzero(lengths):
            s = scores[of == d]
            assert np.isclose(path_value(s, path[of == d], penalty), brute_viterbi(s, penalty), atol=1e-3)


def test_path_without_the_main_language():
    """Two runs, neither of which gains the penalty alone, together beat the language between them."""
    scores = np.array([[0, 7, -20], [0, -20, 7]], np.float32)
    path = langid.best_path(scores, np.array([2]), np.zeros(2, np.int64), 12.0)
    assert path.tolist() == [1, 2] and path_value(scores, path, 12.0) == brute_viterbi(scores, 12.0) == 2


def test_spans_and_scripts(docs, prose):
    train = docs([(i, prose(lang, 200, i), lang, "s") for i, lang in enumerate(["en", "de", "ru"] * 6)])
    model = langid.learn(train)
    mixed = prose("en", 40, 99) + " " + prose("de", 60, 98)
    got = langid.detect(docs([(1, mixed, None, None), (2, prose("ru", 5, 97), None, None), (3, "123 !?", None, None)]), model)
    rows = {r["row"]["doc_id"]: r for r in got.collect()}
    assert rows[1]["lang_pred"] == "de" and [s["lang"] for s in rows[1]["spans"]] == ["en", "de"]
    cut = rows[1]["spans"][1]["start"]
    assert abs(cut - len(prose("en", 40, 99)) - 1) < 40
    assert rows[2]["lang_pred"] == "ru" and rows[2]["score"] > 0.9
    assert rows[3]["lang_pred"] == "und" and rows[3]["score"] == 0 and rows[3]["spans"] == []


def test_odd_rows(odd, docs):
    got = langid.language_query(odd)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["lang_pred"] == by_id[2]["lang_pred"] == by_id[3]["lang_pred"] == "und"
    assert langid.language_query(docs([])).count() == 0
    kept = langid.language_stage(odd)
    assert kept.columns == odd.columns


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_query(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_stage_threshold(docs):
    """A quarter of the evidence is enough: three languages in equal parts stay, six go."""
    parts = {"a": "ba be bi", "b": "do du da", "c": "fi fo fu", "d": "gra gre gro", "e": "klu kla kle", "f": "mist most mast"}

    def text(lang, n, seed):
        rng = np.random.default_rng([seed, ord(lang)])
        return " ".join("".join(rng.choice(parts[lang].split(), rng.integers(2, 5))) for _ in range(n))

    train = [(i, text("abcdef"[i % 6], 120, i), "abcdef"[i % 6], "s") for i in range(72)]
    mixed = [(1001, " ".join(text(x, 60, 500) for x in "abc"), None, "s"), (1002, " ".join(text(x, 60, 501) for x in "abcdef"), None, "s")]
    df = docs(train + mixed)
    got = langid.detect(df, langid.learn(langid.learnable(df), sample_key=F.col("doc_id")))
    score = {r["row"]["doc_id"]: r["score"] for r in got.collect()}
    assert 0.25 <= score[1001] < 0.5 and 0 < score[1002] < 0.25
    assert {r["doc_id"] for r in langid.language_stage(df).collect()} == {i for i, s in score.items() if s >= 0.25}
    assert "quarter" in corpus_pipeline.language.__doc__ and "quarter" in langid.language_stage.__doc__
