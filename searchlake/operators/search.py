"""Ranked retrieval with Okapi BM25 (single query and batches of queries).

Plan shape (Catalyst does the physical work):

    query terms (stored: broadcast if their bytes allow) ⋈ term_stats  -> idf per (qid, term)
    postings ⋈ broadcast(idf rows)                           -> BroadcastHashJoin, postings streamed
    groupBy(qid, doc) sum/count                               -> partial agg, one exchange
    top-k per query                                           -> WindowGroupLimit before the exchange
                                                                 (a batch: k rows per document shard)
    top-k ⋈ doc_stats (titles)                                -> late materialisation, k rows per query
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchlake.constants import BM25_B, BM25_K1, DEFAULT_LIMIT, MAX_LIMIT, MIN_LIMIT
from searchlake.functions.scoring import idf, term_score
from searchlake.functions.text import query_tokens
from searchlake.operators.index import Index, _lookup, term_bucket
from searchlake.operators.shards import top_in_shards, with_keys
from searchlake.session import one_row, stored

_INT = re.compile(r"[+-]?[0-9]+")
MAX_PUSHDOWN_TERMS = 1024
BATCH_PUSHDOWN_TERMS = 64


def parse_limit(value: str | None) -> int:
    """Result limit from a request parameter: blank/None/non-numeric -> 10,
    otherwise clamped to 1..100 (strict integer syntax, no spaces)."""
    if value is None or not value.strip():
        return DEFAULT_LIMIT
    if not _INT.fullmatch(value):
        return DEFAULT_LIMIT
    n = int(value)
    if n < -(2**31) or n > 2**31 - 1:
        return DEFAULT_LIMIT
    return min(MAX_LIMIT, max(MIN_LIMIT, n))


def query_terms(queries: DataFrame, qid: str = "qid", text: str = "query") -> DataFrame:
    """(qid, term) for each distinct token of each query."""
    return queries.select(F.col(qid), F.explode(query_tokens(text)).alias("term"))


def _term_weights(
    index: Index, qterms: DataFrame, qid: str, literal_terms: list[str] | None = None
) -> DataFrame:
    """(qid, term, idf, avgdl) for query terms that exist in the index
    (at most one row per query term)."""
    term_stats = index.term_stats
    if literal_terms is not None:
        term_stats = term_stats.where(F.col("term").isin(literal_terms))
    stats = term_stats.join(qterms, "term")
    corpus = one_row(index.corpus.select("n_docs", "avgdl"))
    return stats.crossJoin(corpus).select(
        F.col(qid), "term", idf("n_docs", "df").alias("idf"), "avgdl"
    )


def _scored_candidates(
    index: Index,
    qterms: DataFrame,
    qid: str,
    k1: float,
    b: float,
    literal_terms: list[str] | None = None,
    single: bool = False,
) -> DataFrame:
    weights = _term_weights(index, qterms, qid, literal_terms)
    postings = index.postings
    if index.bucketed:
        # Join on (bucket, term): the broadcast query side prunes bucket
        # partitions of the postings table at run time.
        weights = weights.withColumn("term_bucket", term_bucket("term"))
        keys = ["term_bucket", "term"]
    else:
        keys = ["term"]
    if literal_terms is not None:
        # A single query: its terms are known, so push them to the scan
        # (partition pruning + row-group skipping on sorted terms).
        postings = postings.where(F.col("term").isin(literal_terms))
        if index.bucketed:
            # Constant folding turns each bucket into a literal for pruning.
            postings = postings.where(
                F.col("term_bucket").isin([term_bucket(F.lit(t)) for t in literal_terms] or [F.lit(-1)])
            )
    # The weights have at most one row per query term.  A single query's are
    # bounded by its string.  A batch's are stored: Spark broadcasts them when
    # their bytes allow it and shuffles otherwise.
    weights = F.broadcast(weights) if single else stored(weights, "query-weights")
    cand = postings.join(weights, keys)
    s = term_score("idf", "tf", "doc_len", "avgdl", k1, b)
    return (
        cand.groupBy(qid, index.key)
        .agg(F.sum(s).alias("raw_score"), F.count(F.lit(1)).cast("int").alias("matched"))
        .select(qid, index.key, F.round("raw_score", 6).alias("score"), "matched")
    )


def _attach_titles(index: Index, top: DataFrame) -> DataFrame:
    """Titles of the top rows: a lookup of their keys."""
    return _lookup(top, index, "doc_stats", index.key, ["title", "snippet"])


def search_batch(
    index: Index,
    queries: DataFrame,
    k: int = DEFAULT_LIMIT,
    qid: str = "qid",
    text: str = "query",
    k1: float = BM25_K1,
    b: float = BM25_B,
    with_titles: bool = False,
) -> DataFrame:
    """Top-``k`` documents per query for a whole table of queries.

    Ranking: score (rounded to 6 places) desc, matched terms desc, key asc.
    An index with document shards is searched shard by shard, and at most k
    rows per query and shard are shuffled (see ``operators.shards``).  Without
    them every candidate is scored and shuffled by (query, document); the
    row_number filter then becomes a WindowGroupLimit that trims every
    partition to k rows per query *before* the exchange on qid.
    """
    qterms = query_terms(queries, qid, text)
    # A small batch pushes its terms into the scans, so only their buckets
    # are read.  A large batch touches most buckets anyway.
    qterms = stored(qterms, "query-terms")
    some = [r.term for r in qterms.select("term").limit(BATCH_PUSHDOWN_TERMS + 1).collect()]
    literal = sorted(set(some)) if len(some) <= BATCH_PUSHDOWN_TERMS else None
    if index.shards is not None and k > 0:
        scored = _best_of_shards(index, qterms, qid, k, k1, b, literal)
    else:
        scored = _scored_candidates(index, qterms, qid, k1, b, literal_terms=literal)
    w = Window.partitionBy(qid).orderBy(F.desc("score"), F.desc("matched"), F.asc(index.key))
    top = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return _attach_titles(index, top) if with_titles else top


def _best_of_shards(index: Index, qterms: DataFrame, qid: str, k: int, k1: float, b: float, literal: list[str] | None) -> DataFrame:
    """``(qid, <key>, score, matched)``: the best k of each query and all that
    tie with the k-th in score and matched terms."""
    size = qterms.agg(F.sum(F.octet_length("term") + 24)).first()[0] or 0
    weights = _term_weights(index, qterms, qid, literal)
    found = top_in_shards(index.shards, weights, qid, k, k1, b, size, literal)
    found = found.select(qid, "shard", "ord", F.round("raw_score", 6).alias("score"), "matched")
    place = F.rank().over(Window.partitionBy(qid).orderBy(F.desc("score"), F.desc("matched")))
    best = found.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
    return with_keys(index.shards, best, index.key).select(qid, index.key, "score", "matched")


def search(
    index: Index,
    query: str,
    limit: int = DEFAULT_LIMIT,
    k1: float = BM25_K1,
    b: float = BM25_B,
    with_titles: bool = False,
) -> DataFrame:
    """Q4: top-``limit`` documents for one keyword query (OR semantics).

    An empty token list or an empty index gives an empty result.  The
    ordering is a TakeOrderedAndProject: each partition keeps its best
    ``limit`` rows and only those reach the final merge.
    """
    spark = index.postings.sparkSession
    q = spark.createDataFrame([(0, query)], "qid int, query string")
    qterms = query_terms(q)
    # One string: its distinct tokens are bounded by its length.  They are
    # pushed into the scans as literals unless there are very many (a whole
    # document used as a query); then the broadcast join alone selects.
    terms = [r.term for r in qterms.collect()]
    literal = terms if len(terms) <= MAX_PUSHDOWN_TERMS else None
    scored = _scored_candidates(index, qterms, "qid", k1, b, literal_terms=literal, single=True).drop("qid")
    top = scored.orderBy(F.desc("score"), F.desc("matched"), F.asc(index.key)).limit(limit)
    w = Window.orderBy(F.desc("score"), F.desc("matched"), F.asc(index.key))
    # ``limit`` rows at most, so the unpartitioned window runs on a bounded set.
    top = top.withColumn("rank", F.row_number().over(w))
    return _attach_titles(index, top) if with_titles else top
