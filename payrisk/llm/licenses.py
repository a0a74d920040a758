"""License scans (operator 6, native): a positional index of rare licence words.

Template notices are indexed by word and position.  A file's highest-IDF licence words are looked up; each hit proposes the
template at (position in the file - position in the template); the template's words are then intersected at that relative position,
and the match stands if enough of the template's IDF mass agrees and its mandatory key phrase stands there.

A template's lookup words are its highest-IDF ones that together hold more than the mass a match may miss, so a file
without any of them cannot match: looking only these up loses nothing.  IDF counts all documents.

Cases: null text is empty and has no word, no place and no label; repeated rows are alike; an empty table gives an empty result; any further
columns stay out.  DataFrame functions only; one narrow pass after the document frequencies, no shuffle of text.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The contract's phrases with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Fixed values: (label, notice, mandatory key phrase), in the words of the contract (lower case, no punctuation).
TEMPLATES = [
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row``, ``norm`` (words joined by single blanks) and ``words``."""
    norm = F.trim(F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), SPLIT, " "))
    # explode() of one element makes the text's words a column of their own: later expressions read it, none recomputes it
    got = docs.select(F.struct("*").alias("row"), F.explode(F.array(norm)).alias("norm"))
    words = F.when(F.col("norm") == "", F.array().cast("array<string>")).otherwise(F.split("norm", " "))
    return got.select("row", "norm", F.explode(F.array(words)).alias("words"))


def word_idf(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of each word of the (fixed) vocabulary over all documents; the driver gets one number per word."""
    n = F.count(F.lit(1)).alias("n")
    rows = (words.select(F.explode(F.array_append(F.array_intersect(F.array(*map(F.lit, vocabulary)), "words"), "")).alias("w")).groupBy("w").agg(n).collect())
    df = {r["w"]: r["n"] for r in rows}
    return {w: math.log((df.get("", 0) + 1) / (df.get(w, 0) + 0.5)) + 1e-6 for w in vocabulary}


def _quoted(xs: list) -> str:
    return ", ".join(f"'{x}'" if isinstance(x, str) else f"{x:.17g}D" for x in xs)


def lookup_words(template: list[str], idf: dict[str, float], slack: float) -> list[str]:
    """Fewest highest-IDF words of a template whose mass is above what a match may miss."""
    total, mass, out = sum(idf[w] for w in template), 0.0, []
    for w in sorted(set(template), key=lambda w: (-idf[w], w)):
        if mass > slack * total:
            break
        out.append(w)
        mass += idf[w] * template.count(w)
    return out


def scan(docs: DataFrame, text_col: str = "text", templates: list = TEMPLATES, phrases: list = PHRASES, share: float = 0.8) -> DataFrame:
    """(row, n_words, n_base, first_word, last_word, base_labels, labels, score) for every file."""
    vocabulary = sorted({w for _, notice, _ in templates for w in notice.split()})
    base = normalised(docs, text_col)
    idf = word_idf(base.select("words"), vocabulary)
    split = [(label, notice.split(), key) for label, notice, key in templates]
    anchors = [lookup_words(ws, idf, 1 - share) for _, ws, _ in split]
    # all lookup words, highest IDF first: array_intersect returns the file's ones in this order
    order = sorted({w for a in anchors for w in a}, key=lambda w: (-idf[w], w))
    rare = F.array_intersect(F.array(*map(F.lit, order)), F.col("words"))
    got = base.select("row", "words", F.concat(F.lit(" "), "norm", F.lit(" ")).alias("padded"), F.explode(F.array(rare)).alias("rare"))
    shares = []
    for (_, ws, key), mine in zip(split, anchors):
        total, near = sum(idf[w] for w in ws), len(ws) + 4
        postings = ", ".join(f"named_struct('w', '{w}', 'at', {i})" for i, w in enumerate(ws) if w in mine)
        starts = (f"array_distinct(flatten(transform(array({postings}), a -> transform(filter(sequence(0, size(words) - 1), i -> words[i] = a.w), i -> i - a.at))))")
        mass = (f"aggregate(transform(array({_quoted(ws)}), (w, i) -> if(coalesce(get(words, d + i) = w, false), array({_quoted([idf[w] for w in ws])})[i], 0D)), 0D, (x, y) -> x + y) / {total:.17g}D")
        keyed = f"contains(concat(' ', array_join(slice(words, greatest(d - 1, 1), {near}), ' '), ' '), ' {key} ')"
        best = f"coalesce(array_max(transform({starts}, d -> if({keyed}, {mass}, 0D))), 0D)"
        shares.append(f"if(arrays_overlap(rare, array({_quoted(mine)})) and contains(padded, ' {key} '), {best}, 0D)")
    got = got.withColumn("shares", F.expr(f"if(size(rare) = 0, cast(array() as array<double>), array({', '.join(shares)}))"))
    has = [F.contains(F.col("padded"), F.lit(f" {p} ")) for p, _ in phrases]
    at = " or ".join("(" + " and ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(p.split())) + ")" for p, _ in phrases)
    some = has[0]
    for h in has[1:]:
        some = some | h
    got = got.withColumn("places", F.when(some, F.expr(f"filter(sequence(0, size(words) - 1), i -> coalesce({at}, false))")))
    names = F.array(*(F.when(h, F.lit(label)) for h, (_, label) in zip(has, phrases)))
    found = F.expr(f"transform(shares, (s, i) -> if(s >= {share}D, array({_quoted([label for label, _, _ in split])})[i], null))")
    got = got.withColumn("names", F.array_compact(names))
    joined = F.array_join(F.array_sort(F.array_distinct(F.concat("names", F.array_compact(found)))), ",")
    return got.select(
        "row", F.size("words").cast("long").alias("n_words"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("_n"), "places",
        F.array_join(F.array_sort(F.array_distinct("names")), ",").alias("base_labels"), joined.alias("labels"), "shares",
    ).select(
        "row", "n_words", F.when(F.col("places").isNull(), 0).otherwise(F.col("_n")).cast("long").alias("n_base"),
        F.when(F.col("_n") > 0, F.array_min("places")).cast("long").alias("first_word"), F.when(F.col("_n") > 0, F.array_max("places")).cast("long").alias("last_word"),
        "base_labels", "labels",
        F.when(F.col("places").isNotNull(), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max("shares"), F.lit(0.0)))).alias("score"))


def license_query(docs: DataFrame) -> DataFrame:
    """op6: doc_id and the scan's columns for all documents."""
    got = scan(docs.select("doc_id", "text"))
    return got.select(F.col("row.doc_id").alias("doc_id"), *got.columns[1:])
