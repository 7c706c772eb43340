"""Gold: the index tables on storage (S4) and the index export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.operators.index import Index, open_tables, write_tables
from searchlake.sources import segments, snapshots

EXPORT_BLOCK = 10_000
# Read exports back with this schema; inference would turn the posting map
# into a struct with one field per document.
EXPORT_SCHEMA = "term string, df string, block int, postings map<string,string>"


def write_index(spark: SparkSession, index: Index, base: str) -> str:
    """Write postings partitioned by a term bucket (a search that joins
    broadcast query terms on (bucket, term) reads only their buckets through
    dynamic partition pruning), plus the statistics tables; then publish the
    new version.  Returns the version name."""
    version = snapshots.new_version()
    write_tables(index, f"{base.rstrip('/')}/{version}")
    snapshots.publish(spark, base, version)
    return version


def read_index(spark: SparkSession, base: str, key: str, version: str | None = None) -> Index:
    """The index published last under ``base``: whole tables or segments."""
    v = version or snapshots.current_version(spark, base)
    if v is None:
        raise FileNotFoundError(f"no index under {base}")
    if segments.is_manifest(v):
        return segments.from_manifest(v).index(spark)
    root = f"{base.rstrip('/')}/{v}"
    return open_tables(spark, root, key)


def export_rows(index: Index, block: int = EXPORT_BLOCK) -> DataFrame:
    """``(term, df, block, postings map<string,string>)`` with df and tf
    as strings, like the reference export.

    A term's postings are split into blocks of about ``block`` entries
    (block = hash(doc) mod ceil(df / block)), so no row -- and no task --
    ever holds the full posting list of a hot term."""
    key = index.key
    ts = index.term_stats.select("term", "df", F.ceil(F.col("df") / F.lit(block)).cast("long").alias("_nb"))
    p = index.postings.join(ts, "term")
    p = p.withColumn("block", F.pmod(F.xxhash64(F.col(key)), F.col("_nb")).cast("int"))
    return p.groupBy("term", "df", "block").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.col("tf").cast("string")))).alias("postings")
    ).select("term", F.col("df").cast("string").alias("df"), "block", "postings")


def export_index(index: Index, path: str) -> None:
    """Write the export as JSON lines plus a one-row stats file."""
    export_rows(index).write.mode("errorifexists").json(f"{path.rstrip('/')}/terms")
    index.corpus.select(
        F.col("n_docs").alias("documentCount"), F.col("avgdl").alias("averageDocumentLength")
    ).coalesce(1).write.mode("errorifexists").json(f"{path.rstrip('/')}/stats")
