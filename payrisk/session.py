"""Session helpers: build a session for tests/bench, and session-scoped settings.

Library code never creates a machine-local scratch folder on a cluster: any
intermediate table goes under ``spark.checkpoint.dir`` as configured by the
cluster.  Only when that setting is missing (tests, local bench) do we create
one under the system temp dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "payrisk",
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench.py (local mode).  Production jobs get their
    session from the cluster and call :func:`configure` on it instead."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Session settings every payrisk job relies on.

    * UTC session zone: all reference timestamps are UTC, window alignment is
      epoch-based.
    * a checkpoint directory: read from the cluster (``spark.checkpoint.dir``);
      only set here when unset.
    """
    spark.conf.set("spark.sql.session.timeZone", UTC)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there).  Without it, local mode gets a fresh temp folder and a cluster
    an error: executors do not see each other's disks.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="payrisk-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/payrisk/{name}-{uuid.uuid4().hex[:12]}"


def landed(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` as Parquet and read back: computed once however often it is used, in memory that does not grow with its rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a :func:`scratch_path` and what is in it, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over two tasks a core: for work that is heavy per row after a scan of few, small or unsplit files."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


__all__ = ["build_session", "configure", "checkpoint_root", "scratch_path", "landed", "drop_path", "spread"]
