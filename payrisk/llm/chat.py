"""Chat formatting (operator 2): the common turns of two conversations become the prompt, the rest two masked completions.

Input: one row per turn, (pair_id, side, turn, role, text), side "chosen" or "rejected".  Turns are ordered by number; the longest
prefix on which both sides agree in role and text is rendered once; each side's remaining turns are rendered as its
completion, with the character ranges of the assistant's words, the only ones a loss should see.

Cases: repeated rows count once; a null text is empty, a null role "unknown", a null turn number comes first; turns with one number are
ordered by role and text; sides that agree throughout leave empty completions; a missing side is an empty conversation;
an empty table gives an empty result.  A pair is one output row, so its turns meet in one task: that is one conversation, however
many pairs there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "|>\n"
END = "\n"


def _render(turns: str) -> str:
    return f"array_join(transform({turns}, t -> concat('{OPEN}', t.role, '{CLOSE}', t.text, '{END}')), '')"


def _mask(turns: str) -> str:
    """Assistant ranges "start-end", comma-joined, in characters of the rendered completion."""
    head = f"(length(t.role) + {len(OPEN) + len(CLOSE)})"
    return f"""array_join(aggregate({turns}, named_struct('at', 0, 'spans', cast(array() as array<string>)), (acc, t) -> named_struct(
        'at', acc.at + {head} + length(t.text) + {len(END)},
        'spans', if(t.role = 'assistant', concat(acc.spans, array(concat(acc.at + {head}, '-', acc.at + {head} + length(t.text)))), acc.spans)),
        acc -> acc.spans), ',')"""


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair: n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask."""
    one = turns.select("pair_id", "side", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                       F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    entry = F.struct("turn", "role", "text")

    def side(name):
        return F.transform(F.array_sort(F.collect_set(F.when(F.col("side") == name, entry))),
                           lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name)

    pairs = one.groupBy("pair_id").agg(side("chosen"), side("rejected"))
    # a position agrees if both sides have it; the first that doesn't ends the prefix
    differ = "filter(sequence(0, greatest(size(chosen), size(rejected))), i -> not coalesce(get(chosen, i) = get(rejected, i), false))"
    pairs = pairs.withColumn("n", F.expr(f"cast({differ}[0] as int)"))
    parts = pairs.selectExpr("pair_id", "n", "slice(chosen, 1, n) as shared", "slice(chosen, n + 1, size(chosen)) as c",
                             "slice(rejected, n + 1, size(rejected)) as r")
    return parts.selectExpr("pair_id", "cast(n as long) as n_prompt_turns", f"{_render('shared')} as prompt", f"{_render('c')} as chosen",
                            f"{_render('r')} as rejected", f"{_mask('c')} as chosen_mask", f"{_mask('r')} as rejected_mask")


def preference_rows(conversations: DataFrame) -> DataFrame:
    """Stand-in input in the operator's schema: each conversation is chosen; rejected is the same with replies cut to their first line
    from the second reply on."""
    base = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    cut = F.when((F.col("role") == "assistant") & (F.col("turn") > 1), F.regexp_extract("text", r"^[^\n]*", 0)).otherwise(F.col("text"))
    return base.withColumn("side", F.lit("chosen")).unionByName(base.withColumn("text", cut).withColumn("side", F.lit("rejected")))


def chat_query(conversations: DataFrame) -> DataFrame:
    """op2: all conversations as preference pairs."""
    return format_pairs(preference_rows(conversations))


SQL = r"""
WITH base AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations),
rows0 AS (SELECT *, 'chosen' AS side FROM base UNION ALL
  SELECT pair_id, turn, role, CASE WHEN role = 'assistant' AND turn > 1 THEN regexp_extract(text, '^[^\n]*') ELSE text END, 'rejected' FROM base),
t AS (SELECT DISTINCT pair_id, side, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM rows0),
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) - 1 AS i FROM t),
c AS (SELECT * FROM r WHERE side = 'chosen'), j AS (SELECT * FROM r WHERE side = 'rejected'),
n AS (SELECT pair_id, greatest(max(CASE WHEN side = 'chosen' THEN i + 1 ELSE 0 END), max(CASE WHEN side = 'rejected' THEN i + 1 ELSE 0 END)) AS most FROM r GROUP BY pair_id),
m AS (SELECT coalesce(c.pair_id, j.pair_id) AS pair_id, min(coalesce(c.i, j.i)) AS n
      FROM c FULL JOIN j ON c.pair_id IS NOT DISTINCT FROM j.pair_id AND c.i = j.i
      WHERE c.role IS DISTINCT FROM j.role OR c.text IS DISTINCT FROM j.text GROUP BY 1),
k AS (SELECT n.pair_id, coalesce(m.n, n.most) AS n FROM n LEFT JOIN m ON n.pair_id IS NOT DISTINCT FROM m.pair_id),
x AS (SELECT r.*, k.n, '<|' || role || '|>' || chr(10) || text || chr(10) AS shown FROM r JOIN k ON r.pair_id IS NOT DISTINCT FROM k.pair_id),
y AS (SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY pair_id, side, i >= n ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + length(role) + 5 AS pos FROM x)
SELECT pair_id, CAST(max(n) AS BIGINT) AS n_prompt_turns,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'chosen' AND i < n), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'chosen' AND i >= n), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'rejected' AND i >= n), '') AS rejected,
  coalesce(string_agg(CAST(pos AS BIGINT) || '-' || CAST(pos + length(text) AS BIGINT), ',' ORDER BY i) FILTER (WHERE side = 'chosen' AND i >= n AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(pos AS BIGINT) || '-' || CAST(pos + length(text) AS BIGINT), ',' ORDER BY i) FILTER (WHERE side = 'rejected' AND i >= n AND role = 'assistant'), '') AS rejected_mask
FROM y GROUP BY pair_id
"""
