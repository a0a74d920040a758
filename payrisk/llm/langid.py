"""Language ID (operator 5): scripts narrow the candidates, Viterbi over words labels the spans.

Learning counts letter trigrams (the letter with its neighbours, a word's edge counting as one) and scripts per
language.  Each word then gets a log-likelihood under every language whose training text used the word's script (under all
languages where none did); Viterbi with a penalty for each switch finds the best sequence of languages, and equal
neighbours form the spans.  The document's language is the one with most letters.

Cases: null text and text without a letter give ``und``, score 0 and no span; a tie goes to the language first by code point;
repeated rows are scored alike; an empty table gives an empty result; without any learnable row every text is ``und``.
Texts are never cut: a text longer than a batch is scored alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.llm.common import attach, codes, id_hash, runs, slices

UNKNOWN = "und"
#: First code points of the script blocks, in order; a letter belongs to the block at or before it.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
]
BUCKETS = 1 << 16
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and letter flag by code point, for code points up to the last letter's block."""
    if not _TABLES:
        chars = [chr(i) for i in range(0x32400)]
        low = [ch.lower() for ch in chars]
        _TABLES["lower"] = np.array([ord(x) if len(x) == 1 else i for i, x in enumerate(low)], np.uint32)
        _TABLES["letter"] = np.array([ch.isalpha() for ch in chars])
    return _TABLES["lower"], _TABLES["letter"]


def _features(texts: list):
    """(letter runs' starts, ends, text of each run, trigram bucket by letter, script of each run, first positions)."""
    lower, letter = _tables()
    c, first = codes(texts)
    c = np.minimum(c, np.uint32(len(lower) - 1))
    low = np.where(letter[c], lower[c], 0).astype(np.uint32)
    prev, nxt = np.concatenate([[0], low[:-1]]).astype(np.uint32), np.concatenate([low[1:], [0]]).astype(np.uint32)
    h = (prev * np.uint32(0x9E3779B1)) ^ (low * np.uint32(0x85EBCA77)) ^ (nxt * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    bucket = (h >> np.uint32(16)).astype(np.int32)
    starts, ends = runs(low > 0)
    block = np.searchsorted([s for s, _ in SCRIPTS], low[starts], side="right") - 1
    names = sorted({n for _, n in SCRIPTS})
    script = np.array([names.index(n) for _, n in SCRIPTS])[block] if len(starts) else np.zeros(0, int)
    return starts, ends, np.searchsorted(first, starts, side="right") - 1, bucket, script, first


def _letters(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all letters of the runs, and the runs' lengths."""
    length = ends - starts
    return np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(int(length.sum())), length


N_SCRIPTS = len({n for _, n in SCRIPTS})


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_key=None, max_rows: int = 20_000,
          alpha: float = 0.1) -> dict:
    """Model from rows with text and language: {"langs", "table" [BUCKETS, L], "scripts" [scripts, L]}.

    At most about ``max_rows`` rows are learnt from (documented bound): those whose hash of ``sample_key`` falls under
    max_rows / rows.  Counts are summed in Spark; the driver gets one number per language and occupied bucket.
    """
    src = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    key = F.xxhash64(F.lit(5), sample_key if sample_key is not None else F.col(text_col))
    n = src.count()
    if n > max_rows:
        src = src.filter(F.pmod(key, F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    src = src.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                starts, ends, of, bucket, script, _ = _features(texts[lo:hi])
                known = sorted(set(langs[lo:hi]))
                code = np.array([known.index(x) for x in langs[lo:hi]])
                letters, length = _letters(starts, ends)
                by_letter = np.repeat(code[of], length)
                for k, lang in enumerate(known):
                    got = np.bincount(bucket[letters[by_letter == k]], minlength=BUCKETS + N_SCRIPTS)
                    got[BUCKETS:] += np.bincount(script[code[of] == k], minlength=N_SCRIPTS)
                    sums[lang] = sums[lang] + got if lang in sums else got
        for lang, got in sums.items():
            keep = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keep)), pa.array(keep.astype(np.int32)),
                                              pa.array(got[keep].astype(np.int64))], names=["lang", "bucket", "n"])

    rows = (src.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n")).collect())
    langs = sorted({r["lang"] for r in rows})
    counts = np.zeros((BUCKETS + N_SCRIPTS, max(len(langs), 1)))
    for r in rows:
        counts[r["bucket"], langs.index(r["lang"])] = r["n"]
    grams, scripts = counts[:BUCKETS] + alpha, counts[BUCKETS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    return {"langs": langs, "table": np.log(grams / grams.sum(axis=0)).astype(np.float32),
            "scripts": share >= 0.001}


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; ``scores`` [words, L] in text order, ``lengths`` words of each text.

    All texts step together, longest first: step t handles the t-th word of every text that has one.
    """
    path = np.zeros(len(scores), np.int32)
    order = np.argsort(-lengths, kind="stable")
    length, first = lengths[order], (np.cumsum(lengths) - lengths)[order]
    if not len(length) or not length[0]:
        return path
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # texts with more than t words
    back = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    v = scores[first[: active[0]]].astype(np.float64)
    best = np.zeros(len(length), np.int32)
    for t in range(1, int(length[0])):
        k = active[t]
        if k < len(v):
            best[k : len(v)] = v[k:].argmax(axis=1)
            v = v[:k]
        top = v.argmax(axis=1)
        jump = v[np.arange(k), top][:, None] - penalty
        stay = v >= jump
        at = first[:k] + t
        back[at] = np.where(stay, np.arange(v.shape[1]), top[:, None])
        v = np.where(stay, v, jump) + scores[at]
    best[: len(v)] = v.argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        path[at] = best[:k]
        best[:k] = back[at, best[:k]]
    return path


def best_path(scores: np.ndarray, words: np.ndarray, of: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi's path for every text.

    A text in which no run of words gains half the penalty or more by another language than the text's best one keeps that
    language throughout: k runs of other languages cost k - 1 switches at least, and one alone is the whole text, which gains
    nothing, so no other path can be better.  Only the rest is stepped.
    """
    some = np.flatnonzero(words)
    first = (np.cumsum(words) - words)[some]
    main = np.zeros(len(words), np.int32)
    main[some] = np.add.reduceat(scores, first, axis=0, dtype=np.float64).argmax(axis=1)
    gain = scores.astype(np.float64) - scores[np.arange(len(of)), main[of]][:, None]
    run = np.cumsum(gain, axis=0)
    drop = (np.abs(gain).max() + 1) * (np.bincount(of).max() + 1) * 4  # a new text starts below all earlier ones
    low = run - drop * of[:, None]
    before = np.minimum.accumulate(low - gain, axis=0)
    most = np.maximum.reduceat((low - before).max(axis=1), first)
    mixed = np.zeros(len(words), bool)
    mixed[some] = most >= penalty / 2
    path = main[of]
    at = mixed[of]
    if at.any():
        path[at] = viterbi(scores[at], words[mixed], penalty)
    return path


SPAN = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPAN)]


def label(texts: list, model: dict, penalty: float) -> dict:
    langs, table, scripts = model["langs"], model["table"], model["scripts"]
    n = len(texts)
    starts, ends, of, bucket, script, first = _features(texts)
    if not langs or not len(starts):
        return {"lang_pred": [UNKNOWN] * n, "score": np.zeros(n),
                "spans": pa.array([[]] * n, type=_span_type())}
    letters, length = _letters(starts, ends)
    scores = np.add.reduceat(table[bucket[letters]], np.cumsum(length) - length, axis=0)
    allowed = scripts[script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    scores = np.where(allowed, scores, scores.min(axis=1, keepdims=True) - 50).astype(np.float32)
    words = np.bincount(of, minlength=n)
    path = best_path(scores, words, of, penalty)
    weight = np.bincount(of * len(langs) + path, weights=length, minlength=n * len(langs)).reshape(n, -1)
    pred = weight.argmax(axis=1)
    total = weight.sum(axis=1)
    share = weight[np.arange(n), pred] / np.maximum(total, 1)
    on = path == pred[of]  # the evidence within the winner's own spans
    like = np.zeros((n, len(langs)))
    some = np.flatnonzero(words)
    like[some] = np.add.reduceat(scores * on[:, None], (np.cumsum(words) - words)[some], axis=0, dtype=np.float64)
    like = np.exp(np.clip(like - like[np.arange(n), pred][:, None], -50, 50))
    score = np.where(total > 0, share / like.sum(axis=1), 0.0)
    new = np.concatenate([[True], (path[1:] != path[:-1]) | (of[1:] != of[:-1])])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(path)]]) - 1
    names = np.array(langs, dtype=object)
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[at], minlength=n))]).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(names[path[at]], pa.string()), pa.array(starts[at] - first[of[at]]),
                                    pa.array(ends[last] - first[of[at]])], names=["lang", "start", "end"]))
    return {"lang_pred": pa.array(np.where(total > 0, names[pred], UNKNOWN), pa.string()),
            "score": np.clip(score, 0.0, 1.0), "spans": spans}


def _span_type():
    return pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def detect(docs: DataFrame, model: dict, text_col: str = "text", penalty: float = 12.0) -> DataFrame:
    """(row, lang_pred, score, spans): every whole text, spans as [start, end) characters of each language."""
    return attach(docs, lambda texts: label(texts, model, penalty), FIELDS, text_col)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows the contract lets us learn from: crc32(doc_id as text) mod 4 is not 2."""
    return docs.filter(id_hash("doc_id", 4) != 2)


def language_query(docs: DataFrame) -> DataFrame:
    """op5: doc_id, held_out, lang_pred, score for all documents."""
    model = learn(learnable(docs), sample_key=F.col("doc_id"))
    got = detect(docs.select("doc_id", "text"), model)
    return got.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score").withColumn(
        "held_out", id_hash("doc_id", 4) == 2).select("doc_id", "held_out", "lang_pred", "score")


def language_stage(docs: DataFrame, min_score: float = 0.25) -> DataFrame:
    """Pipeline: documents without a language, or in so many that none has a quarter of the evidence, go."""
    model = learn(learnable(docs), sample_key=F.col("doc_id"))
    return detect(docs, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
