"""Versioned table folders: every write goes to a fresh ``v=<stamp>`` folder
and becomes current by one more pointer file, so a path that is being read is
never overwritten and an earlier pointer is never touched (no MERGE-capable
table format needed)."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _pointers(base: str) -> str:
    return base.rstrip("/") + "/_published"


def current_version(spark: SparkSession, base: str) -> str | None:
    """The version published last, None when nothing was published yet.
    Every other storage error is raised: taking it for "no version" would
    start an empty table over a full one."""
    try:
        published = spark.read.schema("version string").option("recursiveFileLookup", "true").json(_pointers(base))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # A pointer's folder is named by its time; a crashed attempt left no row.
    last = published.selectExpr("_metadata.file_path AS path", "version").where("version IS NOT NULL").orderBy("path", ascending=False).first()
    return last["version"] if last else None


def publish(spark: SparkSession, base: str, version: str) -> None:
    """Make ``version`` current: append a pointer, named by its time."""
    path = f"{_pointers(base)}/{time.time_ns():020d}"
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("errorifexists").json(path)


def new_version() -> str:
    return f"v={time.time_ns()}"


def write_versioned(df: DataFrame, base: str, name: str, version: str, partition_by: list[str] | None = None) -> str:
    path = f"{base.rstrip('/')}/{version}/{name}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
