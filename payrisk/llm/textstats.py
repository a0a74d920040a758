"""Statistics of whole texts, vectorised over a batch (quality classifier and quality rules share them)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import types as T

from payrisk.llm.common import codes, is_space, mix64, runs, word_hashes

#: Fixed values of the quality contract: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["log_words", "mean_word", "log_longest", "symbol_rate", "upper_rate", "shout_rate", "digit_rate", "mark_rate",
         "dup_line_rate", "repeat_rate", "distinct_rate", "echo_rate", "short_rate", "line_rate", "open_line_rate",
         "capital_rate"]
FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in RATES]
_FLAGS: list[np.ndarray] = []


def _flags() -> np.ndarray:
    """Bits by code point: 1 letter, 2 upper case, 4 digit."""
    if not _FLAGS:
        _FLAGS.append(np.array([ch.isalpha() + 2 * ch.isupper() + 4 * ch.isdigit() for ch in map(chr, range(0x20000))], np.uint8))
    return _FLAGS[0]


def _repeated(key: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _first_of(key: np.ndarray) -> np.ndarray:
    """True at the first place of each key."""
    order = np.argsort(key, kind="stable")
    out = np.ones(len(key), bool)
    out[order[1:][key[order][1:] == key[order][:-1]]] = False
    return out


def stats(texts: list) -> dict[str, np.ndarray]:
    """One array per column of FIELDS; a null text counts as an empty one (all zeros)."""
    n = len(texts)
    c, first = codes(texts)
    space = is_space(c)
    starts, ends = runs(~space)
    of = np.searchsorted(first, starts, side="right") - 1
    length = ends - starts

    def by_text(values: np.ndarray, at: np.ndarray = of) -> np.ndarray:
        return np.bincount(at, weights=values, minlength=n)

    def by_char(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, first[:-1], dtype=np.int64) if n else np.zeros(0, np.int64)

    words = np.bincount(of, minlength=n)
    chars = by_text(length)
    hashes = word_hashes(c, starts, ends)
    salted = mix64(hashes ^ mix64(of.astype(np.uint64)))
    # words in three-word windows that occur again in the same text
    again = np.zeros(len(starts), bool)
    if len(starts) > 2:
        whole = of[2:] == of[:-2]
        key = mix64(salted[:-2] + mix64(salted[1:-1] + mix64(salted[2:])))[whole]
        at = np.flatnonzero(whole)[_repeated(key)]
        again[at] = again[at + 1] = again[at + 2] = True
    # lines with a word, equal to an earlier line of the same text
    breaks = np.flatnonzero(c == 10)
    line_start, line_end = np.concatenate([[0], breaks + 1])[:-1], breaks
    has = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[has], line_end[has]
    line_of = np.searchsorted(first, line_start, side="right") - 1
    dup = ~_first_of(mix64(word_hashes(c, line_start, line_end) ^ mix64(line_of.astype(np.uint64))))
    lines = np.bincount(line_of, minlength=n)
    last = c[np.maximum(ends[np.searchsorted(starts, line_end) - 1] - 1, 0)] if len(line_end) else np.zeros(0, np.uint32)
    open_line = ~np.isin(last, [ord(x) for x in ".!?:;\"')"])
    flags = _flags()[np.minimum(c, np.uint32(0x1FFFF))]
    letter, upper, digit = flags & 1 > 0, flags & 2 > 0, flags & 4 > 0
    symbol = np.isin(c, [ord(x) for x in SYMBOLS])
    mark = ~(space | letter | digit)
    letters = by_char(letter)
    up = np.concatenate([[0], np.cumsum(upper)])
    let = np.concatenate([[0], np.cumsum(letter)])
    word_upper, word_letters = up[ends] - up[starts], let[ends] - let[starts]
    longest = np.zeros(n)
    if len(starts):
        some = np.flatnonzero(words)
        longest[some] = np.maximum.reduceat(length, (np.cumsum(words) - words)[some])
    echo = np.zeros(len(starts), bool)
    if len(starts) > 1:
        echo[1:] = salted[1:] == salted[:-1]
    w, ln, let_n, ch = np.maximum(words, 1), np.maximum(lines, 1), np.maximum(letters, 1), np.maximum(chars, 1)
    n_symbols, n_dup, n_again = by_char(symbol), by_text(dup, line_of), by_text(again)
    return {
        "n_words": words.astype(np.int64), "word_chars": chars.astype(np.int64), "n_symbols": n_symbols.astype(np.int64),
        "n_dup_lines": n_dup.astype(np.int64), "n_repeat_words": n_again.astype(np.int64),
        "log_words": np.log1p(words), "mean_word": chars / w, "log_longest": np.log1p(longest),
        "symbol_rate": n_symbols / w, "upper_rate": by_char(upper) / let_n,
        "shout_rate": by_text((word_upper > 1) & (word_upper == word_letters)) / w, "digit_rate": by_char(digit) / ch,
        "mark_rate": by_char(mark) / ch, "dup_line_rate": n_dup / ln, "repeat_rate": n_again / w,
        "distinct_rate": by_text(_first_of(salted)) / w, "echo_rate": by_text(echo) / w, "short_rate": by_text(length <= 3) / w,
        "line_rate": lines / w, "open_line_rate": by_text(open_line, line_of) / ln,
        "capital_rate": by_text((word_upper == 1) & (word_letters > 1)) / w,
    }
