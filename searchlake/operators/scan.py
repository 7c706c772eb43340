"""Skew-safe running scans per key (prefix max/min, running index).

A window ``PARTITION BY key ORDER BY ...`` sends all rows of one key to one
task; if a key holds a third of the data that task does a third of the
work.  Instead:

1. ``repartitionByRange(key, order...)`` cuts the ordered data into balanced
   contiguous chunks (a hot key spans many chunks); the chunk id is the
   partition id.  Every range shuffle samples its own bounds, so the chunks
   are written once, with their id as a column, before they are read twice;
2. the scan runs locally per (key, chunk);
3. a small per-(key, chunk) summary (count, chunk aggregate) gets its own
   exclusive prefix over chunks -- at most one row per chunk per key;
4. the summary joins back on (key, chunk) and is combined with the local
   result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.session import stored


def chunk_rows(df: DataFrame, key: str, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Add ``_chunk`` (balanced range chunk, stored) and ``_k`` (1-based index
    of the row inside its (key, chunk) in scan order).  Without ``partitions``
    adaptive execution sizes the chunks."""
    by = [F.col(key), *order]
    rp = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    rp = stored(rp.withColumn("_chunk", F.spark_partition_id()), "chunks")
    w = Window.partitionBy(key, "_chunk").orderBy(*order)
    return rp.withColumn("_k", F.row_number().over(w))


def local_window(key: str, order: list[Column]) -> Window:
    return Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def chunk_prefix(summary: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Exclusive prefix over chunks: ``_off`` = rows in earlier chunks and,
    per ``{out: agg}`` with agg in {'max','min'}, the aggregate of the
    column ``out`` over earlier chunks (NULL for the first chunk)."""
    w = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    out = summary.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    for name, agg in cols.items():
        fn = F.max if agg == "max" else F.min
        out = out.withColumn("_prev_" + name, fn(name).over(w))
    return out


def next_value_min(df: DataFrame, key: str, order: list[Column], value: str, out: str, partitions: int | None = None) -> DataFrame:
    """``out`` = min of ``value`` over the rows strictly after each row (in
    ``order``) within its key -- e.g. "the next finish after this poll".

    Runs as a chunked scan in descending order, so no key's rows are
    gathered in one task.
    """
    desc = [c.desc() for c in order]
    c = chunk_rows(df, key, desc, partitions)
    w_excl = Window.partitionBy(key, "_chunk").orderBy(*desc).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_loc", F.min(value).over(w_excl))
    summary = c.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_cmin"))
    summary = chunk_prefix(summary, key, {"_cmin": "min"}).select(key, "_chunk", "_prev__cmin")
    j = c.join(summary, [key, "_chunk"])
    return j.withColumn(out, F.least("_loc", "_prev__cmin")).drop("_chunk", "_k", "_loc", "_prev__cmin")


def running_total(df: DataFrame, key: str, order: list[Column], amount: str, out: str, partitions: int | None = None) -> DataFrame:
    """``out`` = sum of ``amount`` over the rows up to and including each row
    (in ``order``) within its key, without gathering a key in one task."""
    c = chunk_rows(df, key, order, partitions)
    c = c.withColumn("_run", F.sum(amount).over(local_window(key, order)))
    summary = chunk_prefix(c.groupBy(key, "_chunk").agg(F.sum(amount).alias("_n")), key, {}).select(key, "_chunk", "_off")
    j = c.join(summary, [key, "_chunk"])
    return j.withColumn(out, (F.col("_off") + F.col("_run")).cast("long")).drop("_chunk", "_k", "_off", "_run")


def global_index(df: DataFrame, key: str, order: list[Column], out: str, partitions: int | None = None) -> DataFrame:
    """``out`` = 1-based position of each row within its key in ``order``
    (a row_number that does not gather a key in one task)."""
    return running_total(df.withColumn("_one", F.lit(1)), key, order, "_one", out, partitions).drop("_one")
