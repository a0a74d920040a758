"""Keep-latest dedupe per key (WIN-1, WIN-2, STR-8).

One aggregate: the newest row per key is the max of a struct
whose first field is the order column and whose remaining fields are the row
itself, so ties have one fixed winner (the row that sorts last), on Spark and
in the SQL oracle alike.  Partial aggregation runs map-side (Spark plans a
sort-based aggregate, the buffer being a struct), so a hot key that repeats a
million times costs one row per map task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` value; ties go to
    the row that is greatest in the remaining columns (left to right)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order]
    packed = F.struct(F.col(order).alias("_o"), *[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.max(packed).alias("_r"))
              .select(*keys, F.col("_r._o").alias(order), *[F.col(f"_r.{c}").alias(c) for c in rest])
              .select(*df.columns))
