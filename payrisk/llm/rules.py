"""Quality rules (operator 7): a decision list learnt by sequential covering, emitted as Spark conditions.

Rules for the bad class are grown one threshold at a time by information gain on two thirds of the labelled rows, and
pruned from the end on the other third; a rule stays if it is precise enough on rows it was not grown on, the rows it
covers are removed, and the next one is grown.  The list is an ordered ``CASE WHEN`` over statistics columns.

Cases: a null or empty text has no word, fails the base rule and is not kept; rows repeated get equal verdicts; without
labelled rows the list is empty and the base rule decides alone; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.quality import document_stats, labelled
from payrisk.llm.textstats import COUNTS, RATES


@dataclass(frozen=True)
class Rule:
    """All conditions (column, "<=" or ">", threshold) hold -> the verdict is bad."""
    conditions: tuple[tuple[str, str, float], ...]
    precision: float
    covered: int

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, t in self.conditions:
            out = out & (F.col(name) <= F.lit(t) if op == "<=" else F.col(name) > F.lit(t))
        return out


def _holds(x: np.ndarray, conditions: list[tuple[int, str, float]]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, op, t in conditions:
        out &= (x[:, j] <= t) if op == "<=" else (x[:, j] > t)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, most: int, steps: int) -> list[tuple[int, str, float]]:
    conditions: list[tuple[int, str, float]] = []
    while len(conditions) < most:
        p, n = bad.sum(), len(bad) - bad.sum()
        if not p or not n:
            break
        now, best = np.log2(p / (p + n)), (1e-9, None)
        for j in range(x.shape[1]):
            for t in np.unique(np.quantile(x[:, j], np.linspace(0, 1, steps), method="lower")):
                low = x[:, j] <= t
                p1, k1 = int((bad & low).sum()), int(low.sum())
                for op, pp, k in (("<=", p1, k1), (">", int(p) - p1, len(bad) - k1)):
                    if pp and (gain := pp * (np.log2(pp / k) - now)) > best[0]:
                        best = (gain, (j, op, float(t)))
        if best[1] is None:
            break
        conditions.append(best[1])
        keep = _holds(x, [best[1]])
        x, bad = x[keep], bad[keep]
    return conditions


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], most_rules: int = 16, most_conditions: int = 4,
          min_precision: float = 0.9, min_rows: int = 3, steps: int = 65, seed: int = 7) -> list[Rule]:
    """Ordered rules from statistics [rows, names] and the bad flag."""
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.arange(len(x))
    while len(rules) < most_rules and bad[left].any():
        part = rng.permutation(left)
        grow, prune = part[: 2 * len(part) // 3], part[2 * len(part) // 3 :]
        conditions = _grow(x[grow], bad[grow], most_conditions, steps)

        def worth(cs):
            at = _holds(x[prune], cs)
            p = (bad[prune] & at).sum()
            return (2 * p - at.sum()) / max(at.sum(), 1)

        while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
            conditions = conditions[:-1]
        hit, test = _holds(x[left], conditions), _holds(x[prune], conditions)
        right = (bad[prune] & test).sum() / max(test.sum(), 1)
        if not conditions or test.sum() < min_rows or right < min_precision:
            break
        rules.append(Rule(tuple((names[j], op, t) for j, op, t in conditions), float(right), int(hit.sum())))
        left = left[~hit]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Kept or not, as one ordered conditional expression over the statistics columns."""
    out = None
    for r in rules:
        out = F.when(r.column(), F.lit(False)) if out is None else out.when(r.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn_from(stats_of: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> list[Rule]:
    """Rules from at most about ``max_rows`` labelled rows (documented bound), chosen by a hash of the id."""
    rows = labelled(stats_of, labels, "quality")
    n = rows.count()
    if n > max_rows:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    got = rows.select("doc_id", "quality", *RATES).orderBy("doc_id", *RATES).collect()
    if not got:
        return []
    x = np.array([[r[c] for c in RATES] for r in got])
    return learn(x, np.array([r["quality"] == 0 for r in got]), RATES)


def rules_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op7: doc_id, the base counts, base_failed and kept for all documents."""
    got = document_stats(docs)
    rules = learn_from(got, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return got.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
