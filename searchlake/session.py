"""Session construction and the few cluster-facing helpers every operator uses."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def get_spark(master: str | None = None, app: str = "searchlake", **conf) -> SparkSession:
    """A session with AQE on, UTC session time and the Spark UI off."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we use it
    as is.  Only when nothing is configured (local tests) do we create one,
    and only in local mode, because a machine-local folder is useless to
    executors on other hosts.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        configured = tempfile.mkdtemp(prefix="searchlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table under the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/searchlake-tables/{name}-{os.urandom(6).hex()}"


@contextmanager
def configured(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` holds while the block runs; jobs must end inside it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (not local) checkpoint.

    The result survives executor loss and keeps the child's partitioning,
    so a frame repartitioned by a key before this call stays co-partitioned.
    """
    checkpoint_dir(df.sparkSession)
    # Without a persisted copy the eager checkpoint computes the plan twice
    # (once for the count, once more to write the checkpoint files).
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared scratch folder.

    Computed once however often it is used, and of known size: Spark itself
    broadcasts it in a join when its bytes are below the session's threshold
    and shuffles it otherwise.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer partitions than task slots.

    A single small file with one row group is read by one task; the work per
    row after it would then run on one core.  With at least as many input
    splits as slots (the cluster case) the frame is returned untouched, so
    texts are never shuffled there.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def one_row(df: DataFrame) -> DataFrame:
    """Broadcast a global aggregate; it has exactly one row by construction."""
    return F.broadcast(df)
