"""Merkle dataset manifest (operator 13): a tree of digests over all rows, built by slot pivots.

Every row becomes a leaf digest; a source's leaves, ascending by id, are hashed in runs of FANOUT until one digest, the source's subroot,
remains; the subroots, ordered by source, are hashed the same way to the root.  One step up is a slot pivot: conditional
aggregates spread the children of each parent into FANOUT columns; their concatenation is hashed, and leaving a child's own column out
gives its siblings.  On the way down every child gets its siblings and its parent's path, so each leaf can be proved, or
folded to a root again, without any other row.

Positions come from one range sort: a row's place in its partition plus the counts of earlier partitions, one count per source and
partition, so no source is gathered.  Only digests are shuffled, never texts.  Levels are landed; there are log16 of the largest source.

Cases: null fields hash as ``-``, differently from empty ones; a null source is a source of its own, first; null ids come first and are
never tampered with (they have no decimal form); rows of equal id are ordered by their leaf, so repeated rows are neighbours and tie
without effect; long texts are hashed whole; an empty table gives an empty result; other columns take no part and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import land

FANOUT = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts' concatenation."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaves(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """(doc_id, tree, leaf, changed): ``tree`` sorts like the source, null first; ``changed`` is the leaf of a row that ``tamper`` names, after
    A-Z of its text became lower-case, else null."""
    fields = [F.col(c) for c in FIELDS]
    lower = F.translate("text", UPPER, UPPER.lower())
    changed = F.lit(None).cast("string") if tamper is None else F.when(tamper, digest(*map(framed, fields[:-1]), framed(lower)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
                       digest(*map(framed, fields)).alias("leaf"), changed.alias("changed"))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with idx, the place from 0 within its ``tree`` by ``order``, and n, the tree's rows."""
    placed = land(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    # one row per tree and partition: a tree of any size is at most as many rows here as there are partitions
    by_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("held").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", "first", before.alias("before"), F.sum("held").over(by_tree).alias("n"))
    idx = F.col("place") - F.col("first") + F.col("before")
    return placed.join(parts, ["tree", "part"]).select("tree", idx.alias("idx"), "n", *[c for c in rows.columns if c != "tree"])


def _slots(nodes: DataFrame, carry: list[str], fanout: int) -> DataFrame:
    """One slot pivot: (tree, idx, n, c0.., d0..), a row per run, its children's digests and what they carry in slot columns."""
    slot = F.col("idx") % fanout
    kept = F.struct(*carry) if carry else None
    aggregates = [F.max(F.when(slot == k, F.col("hash"))).alias(f"c{k}") for k in range(fanout)]
    if kept is not None:
        aggregates += [F.max(F.when(slot == k, kept)).alias(f"d{k}") for k in range(fanout)]
    runs = nodes.groupBy("tree", F.floor(F.col("idx") / fanout).alias("run")).agg(F.max("n").alias("n"), *aggregates)
    return runs.withColumnRenamed("run", "idx")


def grow(nodes: DataFrame, carry: list[str], name: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """(landed runs of each level, lowest first; (tree, hash) of the tops).  A tree of one node is passed up as it is."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while not levels or most > 1:
        levels.append(land(_slots(nodes, carry if not levels else [], fanout), f"{name}-{len(levels)}"))
        joined = digest(*[F.col(f"c{k}") for k in range(fanout)])
        nodes = levels[-1].select("tree", "idx", F.ceil(F.col("n") / fanout).alias("n"), F.when(F.col("n") == 1, F.col("c0")).otherwise(joined).alias("hash"))
        most = -(-most // fanout)
    return levels, nodes.select("tree", "hash")


def descend(levels: list[DataFrame], tops: DataFrame, carry: list[str], fanout: int = FANOUT) -> DataFrame:
    """Lowest nodes with hash, path and what they carry; ``tops``: (tree, path, ..), further columns are handed down.

    ``path`` lists (left, right), the siblings before and after, from the node's own level up; a node alone in its tree adds none.
    """
    above = tops.withColumn("idx", F.lit(0).cast("long"))
    handed = [c for c in above.columns if c not in ("tree", "idx", "path")]
    for depth, runs in reversed(list(enumerate(levels))):
        def child(k):
            left, right = (F.concat_ws("", *[F.col(f"c{j}") for j in side]) if side else F.lit("") for side in (range(k), range(k + 1, fanout)))
            kept = [F.col(f"d{k}").alias("d")] if not depth and carry else []
            return F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("hash"), left.alias("left"), right.alias("right"), *kept)

        met = runs.join(above, ["tree", "idx"])
        spread = met.select("tree", "idx", "n", "path", *handed, F.inline(F.array(*[child(k) for k in range(fanout)]))).filter("hash is not null")
        path = F.when(F.col("n") > 1, F.concat(F.array(F.struct("left", "right")), F.col("path"))).otherwise(F.col("path"))
        kept = ["hash", *[F.col(f"d.{c}").alias(c) for c in carry]] if not depth else []
        above = spread.select("tree", (F.col("idx") * fanout + F.col("k")).alias("idx"), path.alias("path"), *handed, *kept)
    return above


def fold(leaf: Column, path: str) -> Column:
    """Root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame, tamper: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, changed, subroot, root, path) of every row; ``path`` is the row's proof, see :func:`descend`."""
    rows = land(leaves(docs, tamper), "merkle-leaves")
    nodes = numbered(rows, ["doc_id", "leaf"], "merkle-order").withColumnRenamed("leaf", "hash")
    levels, subroots = grow(nodes, ["doc_id", "changed"], "merkle", fanout)
    upper = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_key"), "hash")
    upper_levels, root = grow(numbered(upper, ["source_key"], "merkle-subroots"), ["source_key"], "merkle-root", fanout)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    sources = descend(upper_levels, root.select("tree", no_path.alias("path"), F.col("hash").alias("root")), ["source_key"], fanout)
    sources = sources.select(F.col("source_key").alias("tree"), "path", "root", F.col("hash").alias("subroot"))
    found = descend(levels, sources, ["doc_id", "changed"], fanout)
    return found.select("doc_id", F.col("hash").alias("leaf"), "changed", "subroot", "root", "path")


def manifest_query(docs: DataFrame) -> DataFrame:
    """op13: leaf, subroot, root, digest of the proof, and whether the row, perhaps tampered with, still folds to the root."""
    tamper = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    got = manifest(docs, tamper)
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = got.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.coalesce("changed", "leaf"), "path").alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql_crc32(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of an ASCII text."""
    table = "list_transform(range(256), lambda b: list_reduce(range(8), lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, b))"
    return f"""xor(4294967295, list_reduce(list_transform(range(length({text})), lambda i: ord(({text})[i + 1])::bigint),
        lambda crc, b: xor(crc // 256, ({table})[xor(crc, b) % 256 + 1]), 4294967295::bigint))"""


def _sql(levels: int = 6, top: int = 3) -> str:
    """Plain form for tables of up to 16^levels rows a source and 16^top sources."""
    def framed_sql(c):
        return f"coalesce(strlen(({c})::varchar)::varchar || ':' || ({c})::varchar, '-')"

    def step(name, k):
        return f"""{name}r{k} as (select tree, idx // 16 as run, max(n) as n, list(h order by idx) as hs from {name}{k} group by all),
{name}{k + 1} as (select tree, run as idx, (n + 15) // 16 as n, case when n = 1 then hs[1] else sha256(array_to_string(hs, '')) end as h from {name}r{k})"""

    def climb(name, k):
        return f"""{name}p{k + 1} as (select p.* replace (p.idx // 16 as idx, case when r.n > 1 then proof || array_to_string(hs[:p.idx % 16], '') || array_to_string(hs[p.idx % 16 + 2:], '') else proof end as proof,
    case when r.n > 1 then sha256(array_to_string(hs[:p.idx % 16], '') || folded || array_to_string(hs[p.idx % 16 + 2:], '')) else folded end as folded)
  from {name}p{k} p join {name}r{k} r on p.tree = r.tree and p.idx // 16 = r.run)"""

    head = " || ".join(framed_sql(c) for c in FIELDS[:-1])
    lower = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    parts = [f"""leaves as (select doc_id, coalesce('s' || source, '') as tree, sha256({head} || {framed_sql('text')}) as h,
    case when {sql_crc32('doc_id::varchar')} % 5 = 0 then sha256({head} || {framed_sql(lower)}) end as changed from documents)""",
             """l0 as (select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as idx, count(*) over (partition by tree) as n from leaves)""",
             *[step("l", k) for k in range(levels)],
             f"""t0 as (select '' as tree, tree as source_key, h, row_number() over (order by tree) - 1 as idx, count(*) over () as n from l{levels})""",
             *[step("t", k) for k in range(top)],
             "lp0 as (select tree, idx, doc_id, h as leaf, '' as proof, coalesce(changed, h) as folded from l0)",
             *[climb("l", k) for k in range(levels)],
             f"tp0 as (select '' as tree, t.idx, p.doc_id, p.leaf, t.h as subroot, p.proof, p.folded from lp{levels} p join t0 t on t.source_key = p.tree)",
             *[climb("t", k) for k in range(top)]]
    return "with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, t.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = t.h as verified from tp{top}, t{top} t"""


SQL = _sql()
