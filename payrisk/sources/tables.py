"""Scans of the driver-provided Parquet tables (SRC-6, SRC-7).

A scan is lazy; a following ``select`` prunes the Parquet ``ReadSchema`` and a
following ``where`` is pushed to the reader, so no helper reads more than the
plan needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``, optionally projecting ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
