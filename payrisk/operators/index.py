"""Contiguous 0-based row index in file order, after filtering (PRJ-9).

No global sort and no single-partition window over rows: every row gets
``monotonically_increasing_id`` (contiguous inside one file block, because a
task reads its blocks in order), one small aggregate gives the first id and
row count of each (file, block), a running sum over that block table (one row
per block) gives each block's offset, and ``offset + id − first id`` is the
index.  The scan must expose ``_metadata.file_path`` and
``_metadata.file_block_start`` as ``_file`` / ``_blk`` (see
:func:`with_file_position`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_file_position(scan: DataFrame, cols: list[str]) -> DataFrame:
    """Project ``cols`` plus the file position columns from a file-source scan."""
    return scan.select(*[F.col(c) for c in cols], F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_blk"))


def contiguous_index(df: DataFrame, name: str = "idx") -> DataFrame:
    """Add ``name`` = 0..n−1 in (file path, block start, row) order; drops the
    position columns."""
    x = df.withColumn("_mid", F.monotonically_increasing_id())
    blocks = x.groupBy("_file", "_blk").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    # one row per file block: bounded by input bytes / block size
    before = Window.orderBy("_file", "_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (x.join(offsets, ["_file", "_blk"])
             .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long"))
             .drop("_file", "_blk", "_mid", "_m0", "_off"))
