"""Tables bucketed and sorted by key (SNK-9, JOIN-1/2): a lookup of one key reads one bucket, a join by the keys doesn't shuffle them again.

The files lie under ``<path>/by-<buckets>``, so a reader in another session finds the number of buckets there and needs no
metastore; the table's name in the session's catalog comes from the path.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def _name(path: str) -> str:
    return "payrisk_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Writes ``df`` in ``buckets`` files hashed and sorted by ``keys`` and returns the table.  ``path`` must be new."""
    name, files = _name(path), f"{path.rstrip('/')}/by-{buckets}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", files).mode("error").saveAsTable(name))
    return df.sparkSession.table(name)


def read_buckets(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The table that :func:`write_buckets` wrote with these keys, in this session or an earlier one."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
        files, buckets = next((s.getPath().toString(), int(s.getPath().getName()[3:])) for s in listed if s.getPath().getName().startswith("by-"))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(files).schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS "
                  f"LOCATION '{files}'")
    return spark.table(name)
