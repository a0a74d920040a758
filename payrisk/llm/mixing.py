"""Mixing sources to target weights (operator 8): weighted fair queueing over shuffled documents.

Sources share the budget (all words) by weight, none beyond ``repeats`` times its size.  Every shuffled document, in each epoch, has
the virtual finish time (words of its source up to and with it) / target of its source; documents are taken in order of that time
until the budget is spent, the last one partly.  Running sums are exact and never in one task: a source is cut into ranges
of the shuffle key, the queue into ranges of virtual time, and only the ranges' totals are summed in order.

Cases: null text has size 0 and is taken 0 times; null source is a source of its own, last; a null id shuffles by the
digest of its text, so rows without id are spread (equal texts without id stand together); repeated rows queue one behind the other; equal finish times go by source, epoch, key, id and size; an empty table gives an
empty result; a source without words has target 0; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import land

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed values of the mixing contract: weights of the sources in order of code point, repeating.
WEIGHTS = (5, 2, 1)
REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_rank, source_size, budget, target) by filling shares up to their caps, smallest cap per weight first.

    Works on one row per source.
    """
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    queue = Window.orderBy(F.col("source_size") / F.col("weight"), "source_rank")
    earlier, rest = queue.rowsBetween(Window.unboundedPreceding, -1), queue.rowsBetween(0, Window.unboundedFollowing)
    # what is left for this source and all after it in the queue, and their weights
    left = F.col("budget") - F.coalesce(F.sum(F.lit(repeats) * F.col("source_size")).over(earlier), F.lit(0))
    one = (one.withColumn("source_rank", F.row_number().over(by_name)).withColumn("weight", w)
           .withColumn("budget", F.sum("source_size").over(everything))
           .withColumn("cap", F.lit(repeats) * F.col("source_size"))
           .withColumn("place", F.row_number().over(queue))
           .withColumn("left", left).withColumn("left_weight", F.sum("weight").over(rest))
           .withColumn("full", F.col("weight") * F.col("left").cast("double") >= F.col("cap").cast("double") * F.col("left_weight")))
    level = F.min(F.when(~F.col("full"), F.struct("place", "left", "left_weight"))).over(everything)
    one = one.withColumn("level", level)
    share = F.col("weight").cast("double") * (F.col("level.left").cast("double") / F.col("level.left_weight").cast("double"))
    target = F.when(F.col("level").isNull() | (F.col("place") < F.col("level.place")), F.col("cap").cast("double")).otherwise(share)
    return one.select("source", "source_rank", "source_size", "budget", target.alias("target"))


def _range_of(key: Column, n: int) -> Column:
    """Order-preserving range (0..n-1) of a hexadecimal key."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") * n / float(1 << 32)).cast("long")


def running_total(df: DataFrame, by: list[str], part: str, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over rows of the same ``by`` up to and with this one, ordered by (part, *order).

    ``part`` is an order-preserving range of the order, so a group larger than a task is summed range by range.
    """
    inside = Window.partitionBy(*by, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy(*by, part).agg(F.sum(value).alias("_part_total"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_{c}") for c in (*by, part)], F.coalesce(F.sum("_part_total").over(before), F.lit(0)).alias("_before"))
    cond = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, part)]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    got = df.withColumn("_inside", F.sum(value).over(inside))
    return got.join(offsets, on).withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside", *[f"_{c}" for c in (*by, part)])


def mix(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = REPEATS, seed: str = "mix", rows_per_range: int = 50_000) -> DataFrame:
    """One row per row of ``sizes(doc_id, source, size)``: source_size, target, taken, copies (epochs in which words are taken).

    A column ``number``, different in every row, is carried through; rows with a null or repeated id are then shuffled by it too.
    A column ``digest`` (text) shuffles the rows without id.
    """
    numbered = "number" in sizes.columns
    unnamed = F.concat(F.lit(":"), F.coalesce("digest", F.lit(""))) if "digest" in sizes.columns else F.lit("")
    text = F.coalesce(F.col("doc_id").cast("string"), unnamed)
    if numbered:
        many = sizes.groupBy("doc_id").count().filter("doc_id is null or count > 1").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_many"))
        sizes = sizes.join(many, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
        text = F.when(F.col("_many"), F.concat(text, F.lit(":"), F.col("number").cast("string"))).otherwise(text)
    sizes = land(sizes.withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))).drop("_id", "_many", "digest"), "mix-sizes")
    ranges = max(8, sizes.count() // rows_per_range + 1)
    targets = land(source_targets(sizes, weights, repeats), "mix-targets")
    docs = sizes.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    docs = docs.withColumn("slot", _range_of(F.col("key"), ranges))
    order = ["key", "doc_id", "size", *(["number"] if numbered else [])]
    docs = docs.withColumn("nth", F.row_number().over(Window.partitionBy("source_rank", "slot").orderBy(*order)))
    docs = land(running_total(docs, ["source_rank"], "slot", ["nth"], "size", "position"), "mix-queue")
    queue = docs.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    queue = queue.withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("position")).cast("double") / F.col("target"))
    queue = queue.withColumn("all", F.lit(0)).withColumn("span", F.floor(F.least("finish", F.lit(1e6)) * ranges).cast("long"))
    queue = running_total(queue, ["all"], "span", ["finish", "source_rank", "epoch", "slot", "nth"], "size", "spent")
    taken = F.greatest(F.lit(0), F.least("size", F.col("budget") - F.col("spent") + F.col("size")))
    got = (queue.withColumn("taken", taken).groupBy("source_rank", "slot", "nth")
           .agg(F.sum("taken").alias("taken"), F.sum((F.col("taken") > 0).cast("long")).alias("copies")))
    return (docs.join(got, ["source_rank", "slot", "nth"], "left")
            .select(*(["number"] if numbered else []), "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies")))


def words(text: str = "text") -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mixing_query(docs: DataFrame) -> DataFrame:
    """op8: doc_id, size, source_size, target, taken for all documents."""
    digest = F.when(F.col("doc_id").isNull(), F.md5(F.col("text").cast("binary")))
    return mix(docs.select("doc_id", F.col("source").cast("string").alias("source"), words().alias("size"), digest.alias("digest"))).drop("source", "copies")


def mixing_stage(docs: DataFrame) -> DataFrame:
    """Pipeline: every document once for each epoch in which the mix takes words of it.

    Rows are numbered and landed, so rows that agree in id, source and size each keep their own copies.
    """
    rows = land(docs.select(F.monotonically_increasing_id().alias("number"), F.struct("*").alias("row")), "mix-rows")
    got = mix(rows.select("number", "row.doc_id", F.col("row.source").cast("string").alias("source"), words("row.text").alias("size")))
    plan = got.filter("copies > 0").select("number", F.col("copies").cast("int").alias("copies"))
    return rows.join(plan, "number").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), ':' || coalesce(md5(text), ''))) AS key FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank, CAST(sum(source_size) OVER () AS BIGINT) AS budget FROM s0),
s2 AS (SELECT *, CAST(CASE (source_rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS weight, 3 * source_size AS cap FROM s1),
s3 AS (SELECT *, row_number() OVER q AS place,
         budget - coalesce(CAST(sum(cap) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS room,
         CAST(sum(weight) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS room_weight
       FROM s2 WINDOW q AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source_rank)),
s4 AS (SELECT min(place) AS place, arg_min(CAST(room AS DOUBLE) / CAST(room_weight AS DOUBLE), place) AS level
       FROM s3 WHERE NOT (weight * CAST(room AS DOUBLE) >= CAST(cap AS DOUBLE) * room_weight)),
s AS (SELECT s3.*, CASE WHEN s4.place IS NULL OR s3.place < s4.place THEN CAST(cap AS DOUBLE) ELSE CAST(weight AS DOUBLE) * s4.level END AS target
      FROM s3 CROSS JOIN s4),
q AS (SELECT d.*, s.source_rank, s.source_size, s.budget, s.target, row_number() OVER w AS nth,
        CAST(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS position
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source WINDOW w AS (PARTITION BY s.source_rank ORDER BY key, doc_id NULLS FIRST, size)),
v AS (SELECT q.*, e.epoch, CAST(e.epoch * source_size + position AS DOUBLE) / target AS finish
      FROM q, (SELECT unnest([0, 1, 2]) AS epoch) e WHERE size > 0),
t AS (SELECT *, CAST(sum(size) OVER (ORDER BY finish, source_rank, epoch, nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS spent FROM v),
g AS (SELECT source_rank, nth, CAST(sum(greatest(0, least(size, budget - spent + size))) AS BIGINT) AS taken FROM t GROUP BY 1, 2)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(g.taken, 0) AS taken
FROM q LEFT JOIN g ON q.source_rank = g.source_rank AND q.nth = g.nth
"""
