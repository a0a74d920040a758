"""Conversation prefix trie (operator 11): a z-fast trie over whole conversations, built and searched by joins.

A conversation is a sequence of turns; its prefixes are named by chained digests, so equal prefixes have equal 16-byte keys.  The trie is
compacted: a node has an extent (a branching point, or where a conversation ends) and the edge of prefixes down to it from its parent's.
Each node is filed under its handle, the prefix whose length is the two-fattest number on the edge (the one divisible by the highest power
of two).  A conversation finds its exit node by fat binary search: it probes the two-fattest length of what is left of its own, a
join on the handle, and halves that; log2(turns) joins place all pending conversations at once.

Conversations are inserted in batches: those pending are located; edges that they leave are cut at every point where one does so; of
those that go on with the same turn one becomes a leaf and the others, now at least one turn deeper, wait for the next batch.
Batches are as many as the most branchings on one way, not as the conversations.  Sums over subtrees go up by pointer doubling,
and edges are expanded to one row per prefix at the end.

Equal conversations are one string with a count.  Copies, hot first turns and wide nodes are only ever counted, with partial sums before the
shuffle.  Texts are never shuffled, only 16-byte digests; one conversation's digests (some 32 bytes a turn) are together in one task.
The digest of the ids that end at a node is streamed over sorted chunks of 4 KB: SHA-256 has no partial sums.

Cases: null role or text is empty; null turn numbers come first; turns with one number are ordered by role, then by digest; repeated rows
are repeated turns; rows without conv_id belong to no conversation and are left out; very long texts are hashed whole; an empty
table has no root and gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import land
from payrisk.llm.merkle import sql_crc32

KEY = 16
CHUNK = 4_096
NOTHING = hashlib.sha256().hexdigest()


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) with turns an array of (digest, bytes) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), F.unhex(F.substring(F.sha2(framed, 256), 1, 2 * KEY)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    lists = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def keyed(lists: DataFrame) -> DataFrame:
    """(conv_id, m, keys, cum) per conversation: m turns, keys of its prefixes 1..m in a row, bytes up to each prefix 0..m."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten()
            sizes = np.array([n or 0 for n in b.column(1).value_lengths().to_pylist()], np.int64)
            digests, bytes_ = flat.field(0).to_pylist(), flat.field(1).to_numpy(zero_copy_only=False)
            keys, cums, at = [], [], 0
            for n in sizes:
                key, chain = b"", []
                for d in digests[at : at + n]:
                    key = hashlib.md5(key + d, usedforsecurity=False).digest()
                    chain.append(key)
                keys.append(b"".join(chain))
                cums.append(np.concatenate([[0], np.cumsum(bytes_[at : at + n])]).astype(np.int64))
                at += n
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(cums, pa.list_(pa.int64()))], names=["conv_id", "m", "keys", "cum"])

    return lists.select("conv_id", "turns").mapInArrow(run, "conv_id long, m long, keys binary, cum array<long>")


def key_at(keys: str, depth: Column | str) -> Column:
    """Key of the prefix of that length; empty for the root's."""
    depth = F.col(depth) if isinstance(depth, str) else depth
    return F.substring(F.col(keys), ((depth - 1) * KEY + 1).cast("int"), F.when(depth > 0, F.lit(KEY)).otherwise(F.lit(0)))


def keys_between(keys: str, after: Column, to: Column, first: Column | int = 0) -> Column:
    """Keys of the prefixes after+1..to, of ``keys`` that begin with the prefix first+1."""
    return F.substring(F.col(keys), ((after - first) * KEY + 1).cast("int"), ((to - after) * KEY).cast("int"))


def two_fattest(after: Column, to: Column) -> Column:
    """The number in (after, to] that the highest power of two divides."""
    top = F.length(F.bin(after.bitwiseXOR(to))) - 1
    return to.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), top))


NODE = ["key", "lo", "hi", "parent", "edge", "cum", "handle", "first"]


def nodes_of(edges: DataFrame) -> DataFrame:
    """Nodes from (lo, hi, parent, edge, cum): key of the extent, key of the handle, key of the edge's first prefix."""
    def at(depth):
        return key_at("edge", depth - F.col("lo"))

    return edges.select(at(F.col("hi")).alias("key"), "lo", "hi", "parent", "edge", "cum", at(two_fattest(F.col("lo"), F.col("hi"))).alias("handle"), at(F.col("lo") + 1).alias("first"))


def locate(pending: DataFrame, trie: DataFrame, steps: int) -> DataFrame:
    """``pending`` (.., m, keys, l) with l raised to the deepest extent that is a prefix, by fat binary search."""
    files = trie.select("handle", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("key").alias("_key"))
    at = pending.withColumn("r", F.col("m"))
    for _ in range(steps):
        probe = F.when(F.col("l") < F.col("r"), two_fattest(F.col("l"), F.col("r")))
        at = at.withColumn("f", probe).withColumn("probe", F.when(F.col("f").isNotNull(), key_at("keys", F.col("f"))))
        at = at.join(files, F.col("probe") == F.col("handle"), "left")
        inside = F.coalesce((F.col("_hi") <= F.col("m")) & (key_at("keys", F.col("_hi")) == F.col("_key")), F.lit(False))
        # handle met: either its extent is a prefix too, or the way leaves this very edge and the search is over
        left = F.when(inside, F.col("_hi")).otherwise(F.coalesce("_lo", "l"))
        right = F.when(F.col("f").isNull() | inside, F.col("r")).otherwise(F.coalesce(F.col("_lo"), F.col("f") - 1))
        at = at.select(*pending.columns[:-1], left.alias("l"), right.alias("r"))
    return at.drop("r")


def exits(located: DataFrame, trie: DataFrame) -> DataFrame:
    """Adds exit (key of the node whose edge the conversation leaves, or null) and q, the length that it shares with the trie."""
    edges = trie.select("first", F.col("key").alias("exit"), F.col("edge").alias("_edge"), F.col("hi").alias("_hi"))
    met = located.join(edges, F.when(F.col("l") < F.col("m"), key_at("keys", F.col("l") + 1)) == F.col("first"), "left")
    # keys name whole prefixes, so those shared are the first ones: the last equal key on the edge ends the common part
    span = F.least(F.col("_hi"), F.col("m"))
    shared = F.size(F.filter(F.sequence(F.col("l") + 1, span), lambda d: key_at("keys", d) == key_at("_edge", d - F.col("l"))))
    return met.withColumn("q", F.when(F.col("exit").isNull(), F.col("l")).otherwise(F.col("l") + shared)).drop("first", "_edge", "_hi")


def insert(strings: DataFrame) -> DataFrame:
    """Compacted nodes (NODE columns) of the distinct ``strings`` (key, m, keys, cum)."""
    spark = strings.sparkSession
    trie = spark.createDataFrame([], "key binary, lo long, hi long, parent binary, edge binary, cum array<long>, handle binary, first binary")
    pending = strings.filter("m > 0").select("key", "m", "keys", "cum", F.lit(0).cast("long").alias("l"))
    batch, none = 0, True
    while True:
        left = pending.agg(F.max(F.col("m") - F.col("l"))).first()[0]
        if left is None:
            return trie
        found = pending if none else locate(pending, trie, int(left).bit_length())
        found = found.withColumn("exit", F.lit(None).cast("binary")).withColumn("q", F.col("l")) if none else exits(found, trie)
        found = land(found.filter("l < m"), f"trie-located-{batch}")  # the others end at a node that is there
        # one leaf for each new branch
        branch = found.filter("q < m").select("*", key_at("keys", F.col("q") + 1).alias("branch"))
        chosen = branch.groupBy("branch").agg(F.min("key").alias("key")).select("key")
        leaves = branch.join(chosen, "key", "left_semi").select(
            F.col("q").alias("lo"), F.col("m").alias("hi"), key_at("keys", "q").alias("parent"), keys_between("keys", F.col("q"), F.col("m")).alias("edge"),
            F.slice("cum", (F.col("q") + 1).cast("int"), (F.col("m") - F.col("q") + 1).cast("int")).alias("cum"))
        # every edge that is left is cut wherever it is; at most as often as it has prefixes
        cuts = found.filter("exit is not null").groupBy("exit").agg(F.sort_array(F.collect_set("q")).alias("cuts"))
        marked = trie.join(cuts, F.col("key") == F.col("exit"), "left")
        whole = marked.filter("exit is null").select(*NODE)
        ends = F.concat(F.array("lo"), "cuts", F.array("hi"))
        pieces = marked.filter("exit is not null").select("*", ends.alias("ends")).select("*", F.posexplode(F.slice("ends", 2, F.size("ends") - 1)).alias("i", "to"))
        pieces = pieces.withColumn("from", F.element_at("ends", F.col("i") + 1))
        pieces = pieces.select(F.col("from").alias("lo"), F.col("to").alias("hi"),
                               F.when(F.col("i") == 0, F.col("parent")).otherwise(key_at("edge", F.col("from") - F.col("lo"))).alias("parent"),
                               keys_between("edge", F.col("from"), F.col("to"), F.col("lo")).alias("edge"),
                               F.slice("cum", (F.col("from") - F.col("lo") + 1).cast("int"), (F.col("to") - F.col("from") + 1).cast("int")).alias("cum"))
        grown = nodes_of(leaves) if none else whole.unionByName(nodes_of(pieces)).unionByName(nodes_of(leaves))
        trie = land(grown, f"trie-{batch}")
        pending = land(branch.join(chosen, "key", "left_anti").select("key", "m", "keys", "cum", F.col("q").alias("l")), f"trie-pending-{batch}")
        batch, none = batch + 1, False


def subtree_sums(nodes: DataFrame, sums: list[str], least: str) -> DataFrame:
    """(key, sums.., least) over each node and all below it, by pointer doubling over (key, parent, ..); parent empty at the top."""
    rows = land(nodes.select("key", F.when(F.octet_length("parent") > 0, F.col("parent")).alias("up"), *sums, least), "trie-sums")
    while not rows.filter("up is not null").isEmpty():
        given = rows.filter("up is not null").groupBy("up").agg(*[F.sum(c).alias(f"_{c}") for c in sums], F.min(least).alias("_least"))
        targets = rows.join(given.select(F.col("up").alias("key")), "key", "left_semi").select(F.col("key").alias("up"), F.col("up").alias("_up"))
        met = rows.join(given.withColumnRenamed("up", "key"), "key", "left").join(targets, "up", "left")
        rows = land(met.select("key", F.col("_up").alias("up"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums], F.least(least, "_least").alias(least)), "trie-sums")
    return rows.drop("up")


def joined_ids(members: DataFrame) -> DataFrame:
    """(key, sha256) of the comma-joined ascending ids of (key, conv_id), streamed: a key's ids are never in memory together."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, first = None, [], 0, None
        for b in batches:
            done = []
            for k, c, place in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if k != key or size >= CHUNK:
                    if held:
                        done.append((key, first, ",".join(held)))
                    key, held, size, first = k, [], 0, place
                held.append(str(c))
                size += len(held[-1]) + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.binary(), pa.int64(), pa.string()))], names=["key", "place", "ids"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)])], names=["key", "place", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done = []
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if state is None or k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.binary(), pa.string()))], names=["key", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "sha256"])

    order = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").withColumn("place", F.monotonically_increasing_id())
    parts = order.mapInArrow(chunks, "key binary, place long, ids string")
    return parts.repartition("key").sortWithinPartitions("key", "place").mapInArrow(hashes, "key binary, sha256 string")


def prefix_trie(lists: DataFrame) -> DataFrame:
    """Every prefix of the conversations (conv_id, turns of (digest, bytes)), one row each, with sums over members and subtree."""
    convs = land(keyed(lists).withColumn("key", key_at("keys", "m")), "trie-conversations")
    strings = land(convs.groupBy("key").agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("m").alias("m"), F.first("keys").alias("keys"), F.first("cum").alias("cum")), "trie-strings")
    nodes = insert(strings)
    total = F.element_at("cum", -1)
    own = strings.select("key", "n", "least", (F.col("n") * total).alias("reach"))
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("children"))
    width = total - F.element_at("cum", 1)
    joined = nodes.join(own, "key", "left").join(children, "key", "left").na.fill(0, ["n", "reach", "children"])
    joined = land(joined.select("*", (F.col("children") == 0).cast("long").alias("leaves"), width.alias("bytes")), "trie-nodes")
    sums = subtree_sums(joined, ["n", "reach", "leaves", "bytes"], "least")
    # the root: no text, everything below it, and the conversations without a turn
    top = joined.filter(F.octet_length("parent") == 0).select("key").join(sums, "key")
    bare = own.filter(F.octet_length("key") == 0)
    root = top.drop("key").unionByName(bare.select("n", "reach", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("bytes"), "least"))
    below = F.count(F.when(F.col("leaves") > 0, 1))
    root = root.agg(F.sum("n").alias("n"), F.sum("reach").alias("reach"), F.greatest(F.sum("leaves"), F.lit(1)).alias("leaves"), F.sum("bytes").alias("bytes"), F.min("least").alias("least"), below.alias("children"))
    root = root.filter("n is not null")
    ids = joined_ids(convs)
    rows = joined.select("key", "parent", "lo", "hi", "cum", "children", F.col("bytes").alias("width")).join(sums, "key").join(ids, "key", "left")
    inner = joined.filter("children > 0").select("key").join(sums.select("key", F.col("least").alias("above")), "key").select(F.col("key").alias("parent"), "above")
    inner = inner.unionByName(root.select(F.lit(b"").alias("parent"), F.col("least").alias("above")))
    rows = rows.join(inner, "parent").select("*", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))).alias("depth"))
    last, top_of_edge = F.col("depth") == F.col("hi"), F.col("depth") == F.col("lo") + 1
    before = F.element_at("cum", (F.col("depth") - F.col("lo")).cast("int"))
    # members' bytes from here on, less each distinct prefix's once
    saved = F.col("reach") - F.col("n") * before - (F.col("bytes") - F.col("width") + total - before)
    expanded = rows.select(F.col("least").alias("conv_id"), "depth", F.when(top_of_edge, F.col("above")).otherwise(F.col("least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
                           F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
                           F.when(last, F.coalesce("sha256", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"))
    ended = ids.filter(F.octet_length("key") == 0).agg(F.max("sha256").alias("sha256"))  # one row at most
    whole = root.crossJoin(F.broadcast(ended)).select(F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                                                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("reach") - F.col("bytes")).alias("saved_tokens"),
                                                      F.coalesce("sha256", F.lit(NOTHING)).alias("ends_sha256"))
    return whole.unionByName(expanded)


def rebuilt(lists: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """Conversations begun anew with the first h turns of conversation c - c % every, h = crc32(c) % (most + 1)."""
    lists = land(lists, "trie-lists")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = lists.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    met = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(heads, "base", "left")
    none = F.slice("turns", 1, 0)
    own = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).otherwise(none)
    return met.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), none), own).alias("turns"))


def trie_query(turns: DataFrame) -> DataFrame:
    """op11: every prefix of the rebuilt conversations."""
    return prefix_trie(rebuilt(turn_lists(turns)))


SQL = f"""with turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from turns),
convs as (select distinct conv_id, {sql_crc32('conv_id::varchar')} % 9 as h from turns),
moved as (select c.conv_id, 0 as part, p.pos, p.role, p.text from convs c join placed p on p.conv_id = c.conv_id - c.conv_id % 5 and p.pos <= c.h
  union all select c.conv_id, 1, p.pos, p.role, p.text from convs c join placed p on p.conv_id = c.conv_id and p.pos > c.h),
built as (select conv_id, row_number() over w as depth, strlen(text) as bytes,
    sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') over w) as key from moved window w as (partition by conv_id order by part, pos)),
members as (select conv_id, 0 as depth, 0 as bytes, '' as key from convs union all select conv_id, depth, bytes, key from built),
lengths as (select conv_id, max(depth) as m from members group by all),
nodes as (select a.key, a.depth, max(a.bytes) as bytes, min(a.conv_id) as conv_id, count(*) as n,
    string_agg(case when l.m = a.depth then a.conv_id::varchar end, ',' order by a.conv_id) as ends from members a join lengths l using (conv_id) group by all),
links as (select distinct a.key as parent, b.key from members a join members b on a.conv_id = b.conv_id and b.depth = a.depth + 1),
counted as (select n.*, count(l.key) as kids from nodes n left join links l on l.parent = n.key group by all),
under as (select distinct a.key as top, b.key from members a join members b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (select u.top, sum(case when c.kids = 0 then 1 else 0 end) as leaves, sum((c.n - 1) * c.bytes) as saved from under u join counted c on c.key = u.key group by all)
select c.conv_id, c.depth::bigint as depth, p.conv_id as parent_conv_id, c.n as n_convs, c.kids as n_children, s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens,
  sha256(coalesce(c.ends, '')) as ends_sha256
from counted c join sums s on s.top = c.key left join links l on l.key = c.key left join nodes p on p.key = l.parent"""
