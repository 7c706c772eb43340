"""Index segments: re-indexing at a cost near the change (J5, ST2).

An index is a list of immutable segments, oldest first.  A segment is a folder
with the tables of an index (see ``operators.index``) and the keys it replaces:

* ``postings`` and ``doc_stats`` of the documents it brings;
* ``deletes(<key>)``: documents whose rows in *earlier* segments are dead;
* ``term_stats`` and ``corpus`` as signed differences: the statistics of the
  whole index are their sums over all segments.

Replacing documents writes one new segment and never rewrites an older one.
Reading takes the segments' rows that no later segment has deleted, through an
anti join with the deleted keys (broadcast by Spark when their bytes allow
it).  A plain index is a segment without deletes.

Segments are merged in tiers: when ``FAN`` of the newest are of one size class
or smaller, they become one.  So each posting is rewritten about once for each
time the index grows ``FAN``-fold, and an index has few segments.

The list is published like a version of a table (``sources.snapshots``): a
crashed attempt leaves an unlisted folder and nothing else.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from dataclasses import replace as with_batch
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.functions.text import snippet
from searchlake.operators import index as ix
from searchlake.session import stored
from searchlake.sources import snapshots

#: Segments of one tier that are merged, and the ratio of sizes between tiers.
FAN = 4


@dataclass(frozen=True)
class Segment:
    root: str
    rows: int  # postings, for the merge rule
    deletes: bool  # whether there is a table of deleted keys


@dataclass(frozen=True)
class SegmentedIndex:
    key: str
    key_type: str
    segments: tuple[Segment, ...]
    batch: int | None = None  # the streaming batch that came last

    def _schema(self, table: str) -> str:
        key = f"`{self.key}` {self.key_type}"
        return {
            "postings": f"{key}, doc_len int, term string, tf int, term_bucket int",
            "doc_stats": f"{key}, doc_len int, title string, snippet string",
            "term_stats": "term string, df long",
            "corpus": "n_docs long, n_terms long, total_len long",
            "deletes": key,
        }[table]

    def _read(self, spark: SparkSession, segment: Segment, table: str) -> DataFrame:
        schema = T.StructType.fromDDL(self._schema(table))
        return spark.read.schema(schema).parquet(f"{segment.root}/{table}").select(*schema.names)

    def _all(self, spark: SparkSession, table: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._read(spark, s, table) for s in self.segments])

    def dead(self, spark: SparkSession) -> DataFrame | None:
        """``(_key, _last)``: the last segment that deleted each key."""
        parts = [
            self._read(spark, s, "deletes").select(F.col(self.key).alias("_key"), F.lit(i).alias("_last"))
            for i, s in enumerate(self.segments) if i and s.deletes
        ]
        if not parts:
            return None
        return stored(reduce(DataFrame.unionByName, parts).groupBy("_key").agg(F.max("_last").alias("_last")), "deleted-keys")

    def live(self, spark: SparkSession, table: str, dead: DataFrame | None) -> DataFrame:
        """The rows of ``postings`` or ``doc_stats`` that no later segment deleted."""
        parts = [self._read(spark, s, table).withColumn("_pos", F.lit(i)) for i, s in enumerate(self.segments)]
        rows = reduce(DataFrame.unionByName, parts)
        if dead is not None:
            # Nothing deletes the newest segment's rows.
            older = reduce(DataFrame.unionByName, parts[:-1])
            gone = F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("_pos") < F.col("_last"))
            rows = older.join(dead, gone, "left_anti").unionByName(parts[-1])
        return rows.drop("_pos")

    def term_stats(self, spark: SparkSession) -> DataFrame:
        """Document frequencies: the sums of the segments' differences."""
        if len(self.segments) == 1:
            return self._read(spark, self.segments[0], "term_stats")
        return self._all(spark, "term_stats").groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")

    def corpus(self, spark: SparkSession) -> DataFrame:
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_docs", "n_terms", "total_len")]
        avgdl = F.when(F.col("n_docs") > 0, F.col("total_len") / F.col("n_docs")).otherwise(F.lit(0.0))
        return self._all(spark, "corpus").agg(*sums).withColumn("avgdl", avgdl)

    def index(self, spark: SparkSession) -> ix.Index:
        """The index of all live rows."""
        dead = self.dead(spark)
        return ix.Index(
            self.key, self.live(spark, "postings", dead), self.live(spark, "doc_stats", dead), self.term_stats(spark), self.corpus(spark)
        )


def of_index(index: ix.Index) -> SegmentedIndex:
    """A written index as one segment, where it lies."""
    if not index.root:
        raise ValueError("only a written index is a segment")
    key_type = index.doc_stats.schema[index.key].dataType.simpleString()
    return SegmentedIndex(index.key, key_type, (Segment(index.root, index.postings.count(), False),))


def first_segment(tok: DataFrame, key: str, root: str) -> SegmentedIndex:
    """A new index out of tokenized rows ``(<key>, title, toks)``."""
    tok = stored(tok, "first")
    titles = tok.select(key, "title").where(F.col("title").isNotNull()) if "title" in tok.columns else None
    return of_index(ix.write_gold(ix.postings_from_tokens(tok, key), key, titles, root, dealt=True))


def replace(spark: SparkSession, old: SegmentedIndex, tok: DataFrame, root: str) -> SegmentedIndex:
    """``old`` with the documents of ``tok(<key>, title, toks)`` re-indexed:
    one more segment under ``root``.  A document without terms vanishes."""
    key = old.key
    title = F.col("title") if "title" in tok.columns else F.lit(None).cast("string")
    changed = stored(tok.select(key, title.cast("string").alias("title"), "toks"), "changed")
    keys = changed.select(key).distinct()
    ix.write_postings(ix.postings_from_tokens(changed, key), root, dealt=True)
    keys.write.mode("errorifexists").parquet(f"{root}/deletes")
    # Two columns, of unlike documents under one key the longer one's.
    lengths = changed.groupBy(key).agg(F.max(F.struct(F.size("toks").alias("doc_len"), "title")).alias("d")).where("d.doc_len > 0")
    docs = lengths.select(key, F.col("d.doc_len").cast("int").alias("doc_len"), F.col("d.title").alias("title"))
    docs.withColumn("snippet", snippet("title")).write.mode("errorifexists").parquet(f"{root}/doc_stats")

    # What the replaced documents had: their live rows, found by streaming
    # the index through the changed keys.
    mine = spark.read.schema(old._schema("deletes")).parquet(f"{root}/deletes").select(F.col(key).alias("_key"))
    known = F.col(key).eqNullSafe(F.col("_key"))
    dead = old.dead(spark)
    had = old.live(spark, "postings", dead).select(key, "term").join(mine, known, "left_semi")
    new = SegmentedIndex(key, old.key_type, (Segment(root, 0, True),))
    signed = new._read(spark, new.segments[0], "postings").select("term", F.lit(1).alias("d")).unionByName(
        had.select("term", F.lit(-1).alias("d"))
    )
    delta = signed.groupBy("term").agg(F.sum("d").alias("df")).where("df <> 0")
    delta.write.mode("errorifexists").parquet(f"{root}/term_stats")
    delta = new._read(spark, new.segments[0], "term_stats")
    before = old.term_stats(spark).join(delta.select("term"), "term", "left_semi").withColumnRenamed("df", "was")
    turned = delta.join(before, "term", "left").select(
        (F.when(F.col("was").isNull(), 1).when(F.col("was") + F.col("df") <= 0, -1).otherwise(0)).alias("t")
    )
    gone = old.live(spark, "doc_stats", dead).join(mine, known, "left_semi").select((-F.col("doc_len")).alias("len"), F.lit(-1).alias("n"))
    came = new._read(spark, new.segments[0], "doc_stats").select(F.col("doc_len").alias("len"), F.lit(1).alias("n"))
    totals = came.unionByName(gone).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_docs"), F.coalesce(F.sum("len"), F.lit(0)).cast("long").alias("total_len")
    )
    terms = turned.agg(F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("n_terms"))
    totals.crossJoin(F.broadcast(terms)).write.mode("errorifexists").parquet(f"{root}/corpus")  # one row each
    rows = new._read(spark, new.segments[0], "postings").count()
    return SegmentedIndex(key, old.key_type, (*old.segments, Segment(root, rows, True)))


def merge_start(rows: list[int], fan: int = FAN) -> int | None:
    """Where the newest segments to merge begin: at least ``fan`` at the end
    of the list, none of a higher tier than the last; None if there is nothing
    to merge."""
    def tier(n: int) -> int:
        return int(math.log(n + 1, fan))

    start = len(rows)
    while start and tier(rows[start - 1]) <= tier(rows[-1]):
        start -= 1
    return start if len(rows) - start >= fan else None


def merge(spark: SparkSession, index: SegmentedIndex, start: int, root: str) -> SegmentedIndex:
    """The segments from ``start`` on as one segment under ``root``; dead rows
    are left out, and deletes where no older segment needs them."""
    part = SegmentedIndex(index.key, index.key_type, index.segments[start:])
    dead = part.dead(spark)
    ix.write_postings(part.live(spark, "postings", dead).drop("term_bucket"), root)
    part.live(spark, "doc_stats", dead).write.mode("errorifexists").parquet(f"{root}/doc_stats")
    sums = part._all(spark, "term_stats").groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")
    sums.write.mode("errorifexists").parquet(f"{root}/term_stats")
    part.corpus(spark).drop("avgdl").write.mode("errorifexists").parquet(f"{root}/corpus")
    if start:
        keys = reduce(DataFrame.unionByName, [part._read(spark, s, "deletes") for s in part.segments if s.deletes])
        keys.distinct().write.mode("errorifexists").parquet(f"{root}/deletes")
    rows = part._read(spark, Segment(root, 0, False), "postings").count()
    return SegmentedIndex(index.key, index.key_type, (*index.segments[:start], Segment(root, rows, bool(start))))


# --- a published list of segments --------------------------------------------------


def is_manifest(version: str) -> bool:
    return version.startswith("{")


def from_manifest(version: str) -> SegmentedIndex:
    m = json.loads(version)
    return SegmentedIndex(m["key"], m["key_type"], tuple(Segment(**s) for s in m["segments"]), m["batch"])


def current(spark: SparkSession, base: str) -> SegmentedIndex | None:
    """The segments published last under ``base``, None if there are none."""
    version = snapshots.current_version(spark, base)
    return from_manifest(version) if version else None


def apply(spark: SparkSession, base: str, tok: DataFrame, key: str, batch: int | None = None, fan: int = FAN) -> SegmentedIndex:
    """Re-index the documents of ``tok`` in the index under ``base`` (a new
    one if there is none), merge what is due and publish the new list.  One
    writer at a time; readers keep the list they opened."""
    old = current(spark, base)

    def folder() -> str:
        return f"{base.rstrip('/')}/seg={uuid.uuid4().hex[:16]}"

    new = first_segment(tok, key, folder()) if old is None else replace(spark, old, tok, folder())
    while (start := merge_start([s.rows for s in new.segments], fan)) is not None:
        new = merge(spark, new, start, folder())
    parts = [{"root": s.root, "rows": s.rows, "deletes": s.deletes} for s in new.segments]
    snapshots.publish(spark, base, json.dumps({"key": key, "key_type": new.key_type, "segments": parts, "batch": batch}))
    return with_batch(new, batch=batch)
