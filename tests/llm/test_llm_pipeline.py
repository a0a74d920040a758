import importlib.util

import corpus_pipeline
from payrisk.llm import langid, minhash, mixing, packing, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, seen = seen, stage(spark, seen, SF)
        rows = [tuple(r) for r in seen.collect()]
        was = [tuple(r) for r in before.collect()]
        assert seen.columns == docs.columns and set(rows) <= set(was)
        ids = sorted(r[0] for r in rows)
        if name == "language":
            want = langid.detect(before, langid.learn(langid.learnable(before), sample_key="doc_id")).filter("lang_pred <> 'und' and score >= 0.25")
            assert ids == sorted(r["row"]["doc_id"] for r in want.collect()) and len(ids) > 0.95 * len(was)
        elif name == "toxicity":
            want = toxicity.score(before, toxicity.learn(toxicity.learnable(before), toxicity.learnable(labels))).filter("score < 0.7")
            assert ids == sorted(r["row"]["doc_id"] for r in want.collect())
        elif name == "near_dedup":
            want = minhash.dedup_query(before).filter("kept")
            assert ids == sorted(r["doc_id"] for r in want.collect())
        else:
            got = mixing.mix(before.select("doc_id", "source", mixing.words().alias("size")))
            assert ids == sorted(r["doc_id"] for r in got.collect() for _ in range(r["copies"]))
        seen = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert pieces.columns == packing.packing_query(seen).columns
    assert pieces.agg({"length": "sum"}).first()[0] == packing.tokenize(seen, packing.default_tokenizer()).agg({"n": "sum"}).first()[0]


def test_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert set(e.oracle_sql()) <= names and importlib.util.find_spec("payrisk.llm")
