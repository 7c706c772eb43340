"""Helpers shared by the operators of this subpackage.

Operators that need whole texts read them once, in Arrow batches inside the
scan's own tasks.  A batch is cut into slices of a few megabytes, so a task
holds the words of one slice at a time, however many rows a batch has.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.session import scratch_path

SLICE_BYTES = 2 << 20
SLICE_ROWS = 4096
CACHE_WORDS = 200_000

#: Every ASCII byte that is no letter or digit becomes a space, A-Z lower case.
ALNUM = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(29))
    h = h * _M2
    return h ^ (h >> np.uint64(32))


def seeds(n: int, seed: int = 0) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed))


class WordHash:
    """64-bit hashes of words.  Hashing a word again costs less than looking
    it up among the many that a large corpus has."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


#: Bytes of an Arrow batch that a task is given at once.
ARROW_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python in batches of bounded bytes (one row at
    least), not of a fixed number of rows however long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


#: What a worker process keeps between its tasks, of one operator at a time.
KEPT: dict[str, object] = {}


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", keeps: str | None = None) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds a few MB of text (or one row).
    What another operator than ``keeps`` kept in this process is let go."""
    for name in KEPT.keys() - {keeps}:
        del KEPT[name]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start, base = 0, 0
        while start < n:
            end = int(np.searchsorted(ends, base + SLICE_BYTES, "right"))
            end = min(max(end, start + 1), start + SLICE_ROWS, n)
            yield batch.slice(start, end - start)
            start, base = end, int(ends[end - 1])


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; a null is an empty text."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def concat(lists: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """All words of the slice in one list, and the word offsets of its texts."""
    ends = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    return [w for words in lists for w in words], ends


def shingle_sets(lists: list[list[bytes]], cache: WordHash, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``width``-word
    shingles; a text of fewer words has its whole sequence as one shingle,
    a text without words none."""
    words, ends = concat(lists)
    if len(words) >= width:
        h = cache.of(words)
        n = len(h) - width + 1
        acc = mix(h[:n])
        for k in range(1, width):
            acc = mix(acc * _GOLD + h[k : k + n])
    else:
        acc = np.empty(0, np.uint64)
    out = []
    for i, own in enumerate(lists):
        if len(own) >= width:
            out.append(np.unique(acc[ends[i] : ends[i + 1] - width + 1]))
        elif own:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(own), len(own))], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def long_list(rows: np.ndarray) -> pa.Array:
    """A matrix of 64-bit values as an Arrow list column."""
    flat = pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64))
    offsets = pa.array(np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, flat)


#: Paths written since each open ``passing`` began.
_PASSING: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when their query ends; at its end go the
    tables ``written`` inside, but for ``lasting`` ones.  No frame that reads
    the others may be used later."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    _PASSING.append([])
    try:
        yield
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _PASSING.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str, lasting: bool = False, **options: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, and
    read again from there when an executor is lost.  It goes at the end of the
    innermost ``passing``, a ``lasting`` one at that of the next around it."""
    path = scratch_path(df.sparkSession, name)
    if around := _PASSING[: len(_PASSING) - lasting]:
        around[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a membership bitmap: 1 MiB at any number of keys.
BITMAP_BITS = 23


def bitmap(hashes: DataFrame, size: int = BITMAP_BITS, packed: bool = False) -> np.ndarray:
    """One bit for each 64-bit hash in ``hashes(h)``, for a broadcast whose
    size does not grow.  A key that was not given may pass; more keys only
    make that likelier."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (size - 3), np.uint8)
        for batch in batches:
            where = place(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), size)
            np.bitwise_or.at(own, where >> 3, np.uint8(128) >> (where & 7).astype(np.uint8))
        words = own.view("<i8")
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int32)), "bits": pa.array(words[at])})

    merged = hashes.mapInArrow(bits, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    full = np.zeros(1 << (size - 6), "<i8")
    full[merged.column("at").to_numpy()] = merged.column("bits").to_numpy()
    return full.view(np.uint8) if packed else np.unpackbits(full.view(np.uint8)).astype(bool)


def place(hashes: np.ndarray, size: int = BITMAP_BITS) -> np.ndarray:
    """The bits of 64-bit hashes in a bitmap."""
    return (hashes >> np.uint64(64 - size)).astype(np.int64)


def marked(docs: DataFrame, id_col: str, bits: np.ndarray, mark: str) -> DataFrame:
    """``docs`` plus whether the hashed id is in a bitmap of hashed ids."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def suspected(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value[place(h.to_numpy(np.int64).view(np.uint64))])

    return docs.withColumn(mark, suspected(F.xxhash64(id_col)))


def without(docs: DataFrame, bad: DataFrame, id_col: str, once: bool = False) -> DataFrame:
    """``docs`` minus the rows whose id is in ``bad(id_col)``; with ``once``
    also minus all rows but one of a repeated id.  Rows without an id stay.

    Rows whose id is not in the bitmap of the ids concerned stay where they
    are; only the others, texts and all, are shuffled to meet the exact list.
    """
    bad = written(bad.select(id_col).where(F.col(id_col).isNotNull()).distinct(), "rejected")
    concerned = bad
    if once:
        often = docs.select(id_col).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col(id_col).isNotNull() & (F.col("_n") > 1))
        concerned = bad.union(often.select(id_col))
    mark = f"suspected_{os.urandom(6).hex()}"  # no column of the input
    known = marked(docs, id_col, bitmap(concerned.select(F.xxhash64(id_col).alias("h"))), mark)
    sure = known.where(~F.col(mark)).select(*docs.columns)
    rest = known.where(F.col(mark)).select(*docs.columns).join(bad, id_col, "left_anti").select(*docs.columns)
    if once:
        rest = rest.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(rest.where(F.col(id_col).isNull()))
    return sure.unionByName(rest)


def crc32_mod(col: str, n: int):
    """crc32 of a column's decimal text, modulo ``n`` (null: that of an empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % F.lit(n)
