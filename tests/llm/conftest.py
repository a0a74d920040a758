import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     T.StructField("score", T.StringType()), T.StructField("row", T.StringType()), T.StructField("key", T.LongType())])


@pytest.fixture()
def docs(spark):
    """Builds a documents table, with further columns whose names clash with internal ones."""
    def build(rows):
        return spark.createDataFrame([(i, t, lang, src, len(t or ""), "x", "y", 7) for i, t, lang, src in rows], DOCS)
    return build


@pytest.fixture()
def odd(docs):
    """Nulls, empty texts, repeated rows, repeated and null ids, blanks only, and one long text."""
    return docs([(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "one two", "en", None), (4, "one two", "en", None),
                 (None, "no id here at all", None, "b"), (5, "a,b 1! 2? ###", "fr", "b"), (5, "other text, same id", "fr", "b"),
                 (6, "word " * 60_000, "en", "a"), (7, "naïve café 漢字 привет", "fr", "a")])


@pytest.fixture()
def prose():
    """Invented prose by a seeded generator, one vocabulary per language."""
    def make(lang, n, seed=0):
        rng = random.Random(f"{lang}{seed}")
        syllables = {"en": ["the", "ing", "er", "sh", "on", "wh", "ou"], "de": ["sch", "ung", "ein", "ich", "pf", "er", "ß"],
                     "ru": ["при", "вет", "ст", "ова", "ния"]}[lang]
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))
    return make
