import re

from payrisk.llm import licenses
from payrisk.llm.licenses import PHRASES, TEMPLATES

TEXTS = ["Released under the MIT License.", "mit-license MIT  LICENSE; the Mit\nlicense", None, "", "Licensed under CC BY-NC 4.0.", "license mit",
         "This work is licensed under the GNU General Public License, version 3. All rights reserved", "general public general public license",
         "Licensed under the Apache License, Version 2.0.", "apache licensed", "PERMISSION is hereby granted, free of charge, to any person obtaining a copy of this software and documentation",
         "permission is hereby", "é MIT LICENSE ü " + "x " * 3000 + "apache license", "İMIT license KIT", "all rights reserved " * 3, "the of and to " * 500]


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, names = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += hits
        names |= {label} if hits else set()
    return words, sorted(at), names


def test_base_and_method(spark, docs):
    d = docs([(i, t, None, None) for i, t in enumerate(TEXTS)])
    got = {r["doc_id"]: r for r in licenses.license_query(d).collect()}
    assert len(got) == len(TEXTS)
    idf = licenses.word_idf(licenses.normalised(d).select("words"), sorted({w for _, n, _ in TEMPLATES for w in n.split()}))
    for i, t in enumerate(TEXTS):
        words, at, names = plain(t)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(at), ",".join(sorted(names)))
        assert (r["first_word"], r["last_word"]) == ((at[0], at[-1]) if at else (None, None))
        best = 0.0  # every template at every place, by the definition
        for label, notice, key in TEMPLATES:
            ws = notice.split()
            for d0 in range(-len(ws), len(words)):
                mass = sum(idf[w] for k, w in enumerate(ws) if 0 <= d0 + k < len(words) and words[d0 + k] == w) / sum(idf[w] for w in ws)
                near = words[max(d0 - 2, 0) :][: len(ws) + 4]
                if mass >= 0.8 and f" {key} " in f" {' '.join(near)} ":
                    names, best = names | {label}, max(best, mass)
        assert r["labels"] == ",".join(sorted(names))
        assert 0 <= r["score"] <= 1 and r["score"] >= (1.0 if at else best) - 1e-9


def test_odd_rows(odd, docs):
    got = licenses.license_query(odd)
    assert got.count() == 10 and got.filter("n_base <> 0 or labels <> ''").count() == 0
    assert licenses.license_query(docs([])).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
