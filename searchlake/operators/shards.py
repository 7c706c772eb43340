"""Document shards of the index, for batch search.

Documents are dealt to shards by a hash of their key and numbered inside a
shard in key order.  A shard holds, for each term, its postings in blocks of
``BLOCK`` documents, each with the block's largest term frequency and least
document length: together they bound the score of every posting in the block,
for any BM25 parameters.

A batch search scores each query inside each shard and hands on at most ``k``
documents per query and shard; that is all that is shuffled.  The tables are
bucketed by shard, so Spark reads a shard into one task without an exchange.
The search inside a shard is a MaxScore evaluation with block bounds:

1. terms are taken by their largest possible score, descending, and
   accumulated over all documents of the shard;
2. when the k-th best sum so far exceeds what the remaining terms can add, a
   document without any sum can't be among the best: only documents that still
   can are kept, and looked up in the remaining terms;
3. a lookup drops a document as soon as its sum, its block's bound and the
   remaining terms stay below the k-th best sum.

Nothing that could reach the k-th rounded score is dropped, so the result
equals the exhaustive plan's.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.session import stored

#: Documents of a shard at most, on average: a task holds one shard's postings
#: while it packs them, and those of the query terms in a search.
SHARD_DOCS = 10_000
#: Blocks handed back to Spark at once.
PACKED_ROWS = 10_000
MAX_SHARDS = 50_000
BLOCK = 128

#: Bytes of (query, term, idf) rows sent to the tasks at once.
WEIGHT_BYTES = 32 << 20

#: Scores are ranked after rounding to six places.
PLACES = 6
MARGIN = 2e-6


@dataclass(frozen=True)
class Shards:
    blocks: DataFrame  # (shard, term, block, max_tf, min_len, ords, tfs, lens), bucketed by shard
    docs: DataFrame  # (shard, ord, <key>), bucketed by shard
    count: int


def shard_of(key: str, shards: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).cast("int")


def shard_count(n_docs: int, at_least: int) -> int:
    return max(1, min(MAX_SHARDS, max(at_least, -(-n_docs // SHARD_DOCS))))


def _bucketed(df: DataFrame, path: str, shards: int, order: list[str]) -> DataFrame:
    """``df`` as Parquet under ``path`` in one bucket file for each task that
    holds a bucket, known to this session by a name of its own."""
    name = f"searchlake_{os.urandom(8).hex()}"
    df.write.bucketBy(shards, "shard").sortBy(*order).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_shards(postings: DataFrame, doc_stats: DataFrame, key: str, root: str, shards: int) -> Shards:
    """The shard tables of an index under ``root``.

    One exchange each, by shard; a frequent term's postings are spread over
    all shards, so no term makes a hot task."""
    docs = doc_stats.select(shard_of(key, shards).alias("shard"), F.col(key)).repartition(shards, "shard")
    docs = docs.withColumn("ord", F.row_number().over(Window.partitionBy("shard").orderBy(key)) - 1)
    rows = postings.select(shard_of(key, shards).alias("shard"), F.col(key).alias("key"), "doc_len", "term", "tf").repartitionById(shards, "shard")
    blocks = rows.groupBy("shard").applyInArrow(_packed, _BLOCKS)
    return Shards(
        _bucketed(blocks, f"{root}/shard_blocks", shards, ["term", "block"]),
        _bucketed(docs.select("shard", "ord", key), f"{root}/shard_docs", shards, ["ord"]),
        shards,
    )


_BLOCKS = "shard int, term string, block int, max_tf int, min_len int, ords array<int>, tfs array<int>, lens array<int>"


def _packed(table: pa.Table) -> pa.Table:
    """The blocks of one shard's postings ``(shard, key, doc_len, term, tf)``;
    documents are numbered by key, nulls first."""
    def rank(name: str) -> np.ndarray:
        return pc.rank(table.column(name), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int32) - 1

    ord_, term = rank("key"), rank("term")
    tf, length = (table.column(c).to_numpy().astype(np.int32) for c in ("tf", "doc_len"))
    order = np.lexsort((length, tf, ord_, term))
    ord_, term, tf, length = ord_[order], term[order], tf[order], length[order]
    n = len(term)
    firsts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    at = np.arange(n) - np.repeat(firsts, np.diff([*firsts, n]))
    starts = np.flatnonzero(at % BLOCK == 0)
    offsets = pa.array(np.append(starts, n).astype(np.int32))
    out = pa.table({
        "shard": pa.array(np.full(len(starts), table.column("shard")[0].as_py(), np.int32)),
        "term": table.column("term").take(pa.array(order[starts])), "block": pa.array((at[starts] // BLOCK).astype(np.int32)),
        "max_tf": pa.array(np.maximum.reduceat(tf, starts)), "min_len": pa.array(np.minimum.reduceat(length, starts)),
        **{name: pa.ListArray.from_arrays(offsets, pa.array(v)) for name, v in (("ords", ord_), ("tfs", tf), ("lens", length))},
    })
    return pa.Table.from_batches(out.to_batches(max_chunksize=PACKED_ROWS))


def read_shards(spark: SparkSession, root: str, shards: int) -> Shards:
    """The shard tables under ``root``, made known to this session."""
    tables = []
    for part in ("shard_blocks", "shard_docs"):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{root}/{part}").schema)
        name = f"searchlake_{os.urandom(8).hex()}"
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (shard) INTO {shards} BUCKETS LOCATION '{root}/{part}'")
        tables.append(spark.table(name))
    return Shards(*tables, shards)


# --- inside a shard -----------------------------------------------------------------


class ShardPostings:
    """One shard's blocks of the query terms, as arrays."""

    def __init__(self, table: pa.Table, avgdl: float, k1: float, b: float):
        table = table.sort_by([("term", "ascending"), ("block", "ascending")]).combine_chunks()
        self.avgdl, self.k1, self.b = avgdl, k1, b
        terms = table.column("term").to_pylist()
        self.range: dict[str, tuple[int, int]] = {}
        for i, term in enumerate(terms):
            self.range[term] = (self.range.get(term, (i, i))[0], i + 1)
        lists = {n: table.column(n).combine_chunks() for n in ("ords", "tfs", "lens")}
        self.ords, self.tfs, self.lens = (x.flatten().to_numpy(zero_copy_only=False) for x in lists.values())
        self.ends = np.concatenate([[0], np.cumsum(np.diff(lists["ords"].offsets.to_numpy()))])
        self.bound = self.impact(table.column("max_tf").to_numpy(), table.column("min_len").to_numpy())
        self.n_docs = int(self.ords.max()) + 1 if len(self.ords) else 0
        # A key that was indexed in two rows has two postings of a term.
        inner = np.ones(max(0, len(self.ords) - 1), bool)
        inner[[self.ends[z] - 1 for _, z in self.range.values() if self.ends[z] < len(self.ords)]] = False
        self.repeats = bool((inner & (np.diff(self.ords) == 0)).any())
        self.full: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        #: Postings whose score was computed, for tests.
        self.scored = 0

    def impact(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The term score for an idf of 1."""
        tf, length = tf.astype(np.float64), length.astype(np.float64)
        ratio = length / self.avgdl if self.avgdl > 0 else np.ones(len(length))
        return tf * (self.k1 + 1.0) / (tf + self.k1 * (1.0 - self.b + self.b * ratio))

    def whole(self, term: str) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a term, computed once for all queries."""
        found = self.full.get(term)
        if found is None:
            a, z = (self.ends[i] for i in self.range[term])
            found = self.full[term] = (self.ords[a:z], self.impact(self.tfs[a:z], self.lens[a:z]))
            self.scored += int(z - a)
        return found

    def lookup(self, term: str, docs: np.ndarray, hopeful) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(kept, at, impact)``: the places in ``docs`` (ascending) that
        stay, those of them the term has, and their impacts.  ``hopeful`` says
        by place and block bound which documents stay at all."""
        first, last = self.range[term]
        a, z = self.ends[first], self.ends[last]
        place = np.minimum(np.searchsorted(self.ords[a:z], docs), z - a - 1) + a
        has = self.ords[place] == docs
        block = np.searchsorted(self.ends, place, "right") - 1
        stays = hopeful(np.where(has, self.bound[block], 0.0))
        at = np.flatnonzero(has & stays)
        self.scored += len(at)
        return np.flatnonzero(stays), at, self.impact(self.tfs[place[at]], self.lens[place[at]])

    def top(self, terms: list[str], idfs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ord, score, matched)`` of the best ``k`` documents, ties by
        matched terms, then by document number."""
        here = [i for i, t in enumerate(terms) if t in self.range]
        most = np.array([idfs[i] * self.bound[slice(*self.range[terms[i]])].max() for i in here])
        order = np.argsort(-most, kind="stable")
        rest = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0.0]])
        total, matched = np.zeros(self.n_docs), np.zeros(self.n_docs, np.int32)
        docs, check = None, rest[0] / 2 if len(here) else 0.0
        for n, at in enumerate(order):
            term, idf = terms[here[at]], idfs[here[at]]
            if docs is None and rest[n] <= check and not self.repeats:
                # Half of the possible score is left: is the k-th sum beyond it?
                least = self._kth(total, k)
                if least > rest[n] + MARGIN:
                    docs = np.flatnonzero(total + rest[n] >= least - MARGIN)
                    total, matched = total[docs], matched[docs]
                check /= 2
            if docs is None:
                own, impact = self.whole(term)
                if self.repeats:
                    np.add.at(total, own, idf * impact)
                    np.add.at(matched, own, 1)
                else:
                    total[own] += idf * impact
                    matched[own] += 1
            else:
                least = max(least, self._kth(total, k))
                kept, found, impact = self.lookup(term, docs, lambda bound: total + idf * bound + rest[n + 1] >= least - MARGIN)
                total[found] += idf * impact
                matched[found] += 1
                docs, total, matched = docs[kept], total[kept], matched[kept]
        docs = np.flatnonzero(matched) if docs is None else docs
        if len(matched) != len(docs):
            total, matched = total[docs], matched[docs]
        best = np.lexsort((docs, -matched, -np.round(total, PLACES)))[:k]
        return docs[best], total[best], matched[best]

    @staticmethod
    def _kth(total: np.ndarray, k: int) -> float:
        """The k-th largest sum, 0 if there are fewer."""
        return float(np.partition(total, len(total) - k)[-k]) if len(total) >= k else 0.0


_TOP = "shard int, query long, ord int, raw_score double, matched int"


def _search_shard(weights, k: int, avgdl: float, k1: float, b: float):
    """Function of one shard: the best documents of each query of the pass."""

    def run(table: pa.Table) -> pa.Table:
        postings = ShardPostings(table, avgdl, k1, b)
        rows = []
        for query, terms, idfs in weights.value:
            ords, score, matched = postings.top(terms, idfs, k)
            rows.append((np.full(len(ords), query, np.int64), ords, score, matched))
        query, ords, score, matched = (np.concatenate(c) for c in zip(*rows))
        shard = np.full(len(ords), table.column("shard")[0].as_py(), np.int32)
        return pa.table({"shard": shard, "query": query, "ord": ords.astype(np.int32), "raw_score": score, "matched": matched.astype(np.int32)})

    return run


def top_in_shards(
    shards: Shards, weights: DataFrame, qid: str, k: int, k1: float, b: float, size: int, literal_terms: list[str] | None = None
) -> DataFrame:
    """``(qid, shard, ord, raw_score, matched)``: at most ``k`` rows for each
    query and shard, out of ``weights(qid, term, idf, avgdl)``.

    The weights go to the tasks by broadcast, at most ``WEIGHT_BYTES`` of
    their ``size`` bytes at a time: a larger batch is searched in several
    passes, each query in one of them."""
    spark = weights.sparkSession
    passes = max(1, -(-size // WEIGHT_BYTES))
    parts = []
    for i in range(passes):
        part = weights.where(F.pmod(F.xxhash64(qid), F.lit(passes)) == i) if passes > 1 else weights
        rows = part.toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        codes = rows.column(qid).combine_chunks().dictionary_encode(null_encoding="encode")
        queries = spark.createDataFrame(pa.table({"query": pa.array(range(len(codes.dictionary)), pa.int64()), qid: codes.dictionary}))
        terms = spark.createDataFrame(pa.table({"term": rows.column("term").unique()}))
        blocks = shards.blocks
        if literal_terms is not None:
            blocks = blocks.where(F.col("term").isin(literal_terms))
        mine = blocks.join(F.broadcast(terms), "term", "left_semi")
        shared = spark.sparkContext.broadcast(_grouped(codes.indices.to_numpy(), rows))
        avgdl = rows.column("avgdl")[0].as_py() or 0.0
        found = mine.groupBy("shard").applyInArrow(_search_shard(shared, k, avgdl, k1, b), _TOP)
        parts.append(found.join(F.broadcast(queries), "query").drop("query"))
    if not parts:
        return weights.where("false").select(qid, *[F.lit(None).cast(f.dataType).alias(f.name) for f in _fields() if f.name != "query"])
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


def _fields() -> list[T.StructField]:
    return T.StructType.fromDDL(_TOP).fields


def _grouped(query: np.ndarray, rows: pa.Table) -> list[tuple[int, list[str], np.ndarray]]:
    """``(query, terms, idfs)`` for each query number."""
    order = np.argsort(query, kind="stable")
    query, terms, idfs = query[order], rows.column("term").take(pa.array(order)).to_pylist(), rows.column("idf").to_numpy()[order]
    ends = [0, *(np.flatnonzero(np.diff(query)) + 1).tolist(), len(query)]
    return [(int(query[a]), terms[a:z], idfs[a:z]) for a, z in zip(ends, ends[1:])]


def with_keys(shards: Shards, top: DataFrame, key: str) -> DataFrame:
    """``top`` plus the documents' keys.  The rows are few, and stored: Spark
    broadcasts them when their bytes allow it, and the shards' documents are
    then only streamed."""
    return shards.docs.join(stored(top, "shard-top"), ["shard", "ord"]).drop("shard", "ord")
