"""Helpers the corpus operators share: landing, row-preserving Arrow maps, text arrays, components.

``attach`` keeps every input column inside one struct while a batch function adds its own columns, so
extra columns of the caller, whatever their names, never clash with ours and never need a join back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.session import scratch_path

#: Characters handled at once by the vectorised text functions (a longer text is handled alone).
CHARS_AT_ONCE = 1_500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage is cut, a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_hash(col: str, divisor: int):
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % divisor


def attach(df: DataFrame, fn: Callable[[list], dict[str, pa.Array | np.ndarray | list]], fields: list[T.StructField],
           text_col: str = "text", size_of: Callable = None) -> DataFrame:
    """``row`` (all input columns as a struct) plus the columns ``fn`` computes from lists of texts.

    ``fn`` gets a list of texts (None for null) of about CHARS_AT_ONCE characters and returns one array per
    field.  The map is narrow: no shuffle, and a retried task gives the same rows.
    """
    src = df.select(F.struct("*").alias("row"))
    pos = [f.name for f in df.schema.fields].index(text_col)
    out = T.StructType([T.StructField("row", src.schema["row"].dataType), *fields])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            texts = rows.flatten()[pos].to_pylist()
            for lo, hi in slices(texts):
                got = fn(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([rows.slice(lo, hi - lo), *(as_arrow(got[n]) for n in names)],
                                                 names=["row", *names])

    return src.mapInArrow(run, out)


def as_arrow(x) -> pa.Array:
    return x if isinstance(x, pa.Array) else pa.array(x)


def slices(texts: list, most: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    lo, n = 0, 0
    for i, t in enumerate(texts):
        k = len(t) if t else 0
        if i > lo and n + k > most:
            yield lo, i
            lo, n = i, 0
        n += k
    if lo < len(texts):
        yield lo, len(texts)


def codes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by one line feed, and the texts' first positions (one more at the end)."""
    texts = [t or "" for t in texts]
    flat = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)


def is_space(c: np.ndarray) -> np.ndarray:
    """True at the characters of ``[\\x20\\x09-\\x0D]``."""
    return (c == 32) | ((c >= 9) & (c <= 13))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def segment_sum(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over [start, end) ranges, empty ranges give 0 (exact for integers and wrapping uint64)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[ends] - total[starts]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: keys come nearly in order here)."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)


def word_hashes(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word from its code points and their places in it."""
    global _POWERS
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    if (most := int(length.max())) > len(_POWERS):
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * most, 0x9E3779B97F4A7C15, np.uint64)]))
    first = np.repeat(starts, length)
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    terms = (c[first + at].astype(np.uint64) + np.uint64(1)) * _POWERS[at]
    return mix64(np.add.reduceat(terms, np.cumsum(length) - length) + length.astype(np.uint64))


def words_of(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, word starts, word ends, text of each word, first positions) for white-space words."""
    c, first = codes(texts)
    starts, ends = runs(~is_space(c))
    return c, starts, ends, np.searchsorted(first, starts, side="right") - 1, first


def block_pairs(rows: DataFrame, keys: list[str], by: str, n: str, most: int, columns: list[str]) -> DataFrame:
    """Deals each group (``keys``, of ``n`` rows) as pairs of blocks of about ``most`` rows: (keys, i, j, side, columns).

    Two rows of a group meet in just one (i, j): on side 0 and 1, or both on side 0 where i = j.
    """
    blocks = (F.col(n) / most + 1).cast("int")
    dealt = rows.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int"))
    spread = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    return spread.select(*keys, F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"),
                         F.when(F.col("_block") <= F.col("_other"), 0).otherwise(1).alias("side"), *columns)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges(a, b)``, for all nodes with an edge.

    Alternating large-star and small-star steps; each round is landed, so lineage stays short and a lost executor
    costs at most one round.  Stars are kept as (node, least neighbour) pairs: minima are pre-aggregated before the
    shuffle, and a hub's rows are spread by AQE's skew join, never gathered.
    """
    def canon(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")

    def stars(df):
        """Every node points to one node at most, and none that points is pointed to."""
        ends = df.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            df.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        sums = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        return sums.filter("out > 1 or (out > 0 and into > 0)").isEmpty()

    e = land(canon(edges.select("a", "b")).distinct(), "cc")
    for _ in range(max_rounds):
        if stars(e):
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = canon(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(low.filter("m < a").select("a", F.col("m").alias("b"))))
        low2 = big.groupBy("a").agg(F.min("b").alias("m"))
        e = land(canon(big.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .unionByName(low2.select("a", F.col("m").alias("b")))).distinct(), "cc")
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
