"""Batch search over document shards against the exhaustive plan."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from searchlake.operators import index as ix
from searchlake.operators import search as se
from searchlake.operators import shards as sh


def corpus(spark, n=400, seed=1, key=str):
    """Zipf words; many documents are equal, so scores tie."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weight = [1 / (i + 1) for i in range(300)]
    rows = []
    for i in range(n):
        source = rng.randrange(i + 1) if i and rng.random() < 0.2 else None
        text = rows[source][1] if source is not None else " ".join(rng.choices(words, weight, k=rng.choice([1, 5, 30, 120])))
        rows.append((key(i), text))
    queries = [(q, " ".join(rng.choices(words, weight, k=rng.choice([1, 2, 8, 30])))) for q in range(60)]
    queries += [(100, ""), (101, "nosuchword"), (102, "w0 nosuchword w299"), (None, "w1 w2"), (103, "w0 " * 50)]
    docs = spark.createDataFrame(rows, "k string, text string" if key is str else "k long, text string")
    return ix.build_index(ix.text_tokens(docs, "k", "text"), "k"), spark.createDataFrame(queries, "qid int, query string")


def rows(df):
    return sorted((tuple(r) for r in df.select("qid", "k", "score", "matched", "rank").collect()), key=repr)


@pytest.fixture(scope="module", params=[str, int])
def built(spark, request):
    """An index, the same with shards of small blocks, and queries."""
    block, sh.BLOCK = sh.BLOCK, 4
    index, queries = corpus(spark, key=request.param)
    out = index, ix.sharded(index, shards=5), queries
    sh.BLOCK = block
    return out


@pytest.mark.parametrize("k,k1,b", [(1, 1.2, 0.75), (10, 2.0, 0.0), (1000, 0.0, 1.0)])
def test_equal_rows(built, k, k1, b):
    index, cut, queries = built
    assert rows(se.search_batch(cut, queries, k, k1=k1, b=b)) == rows(se.search_batch(index, queries, k, k1=k1, b=b))


def test_at_most_k_rows_per_query_and_shard_are_shuffled(built):
    _, cut, queries = built
    qterms = se.query_terms(queries)
    found = sh.top_in_shards(cut.shards, se._term_weights(cut, qterms, "qid"), "qid", 3, 1.2, 0.75, 1)
    assert found.groupBy("qid", "shard").count().agg(F.max("count")).first()[0] <= 3
    # Spark reads a shard into one task by itself: no exchange below the search.
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("FlatMapGroupsInArrow"):]
    assert "Exchange hashpartitioning" not in below
    assert "Bucketed: true" in below or "SelectedBucketsCount" in below


def test_small_batches_and_several_passes(built, monkeypatch):
    index, cut, queries = built
    few = queries.where("qid < 3")
    assert rows(se.search_batch(cut, few)) == rows(se.search_batch(index, few))
    want = rows(se.search_batch(index, queries))
    monkeypatch.setattr(sh, "WEIGHT_BYTES", 2000)
    assert rows(se.search_batch(cut, queries)) == want


def test_titles_empty_batches_and_an_empty_index(spark):
    index, queries = corpus(spark, 80)
    cut = ix.sharded(index, shards=3)
    assert se.search_batch(cut, queries.where("false")).collect() == []
    assert se.search_batch(cut, queries.where("qid = 101")).collect() == []
    assert se.search_batch(cut, queries, 0).collect() == []
    assert "title" in se.search_batch(cut, queries, with_titles=True).columns
    none = ix.build_index(ix.text_tokens(spark.createDataFrame([], "k string, text string"), "k", "text"), "k")
    assert se.search_batch(ix.sharded(none), queries).collect() == []


def test_shards_read_back(spark, tmp_path):
    index, queries = corpus(spark, 120)
    cut = ix.sharded(index, str(tmp_path / "s"), 3)
    again = replace(cut, shards=sh.read_shards(spark, str(tmp_path / "s"), 3))
    assert rows(se.search_batch(again, queries)) == rows(se.search_batch(cut, queries))
    assert cut.shards.docs.count() == index.doc_stats.count()


def test_a_key_indexed_twice_counts_both_rows(spark):
    docs = spark.createDataFrame([(1, "aa bb cc"), (1, "aa aa dd ee"), (2, "aa bb"), (3, "bb")], "k long, text string")
    index = ix.build_index(ix.text_tokens(docs, "k", "text"), "k")
    queries = spark.createDataFrame([(1, "aa"), (2, "aa bb dd")], "qid int, query string")
    assert rows(se.search_batch(ix.sharded(index, shards=2), queries)) == rows(se.search_batch(index, queries))


def packed(postings, block):
    """A shard's block table out of {term: [(ord, tf, len)]}."""
    out = []
    for term, rows_ in sorted(postings.items()):
        for i in range(0, len(rows_), block):
            part = rows_[i : i + block]
            ords, tfs, lens = (list(c) for c in zip(*part))
            out.append({"shard": 0, "term": term, "block": i // block, "max_tf": max(tfs), "min_len": min(lens), "ords": ords, "tfs": tfs, "lens": lens})
    ints = pa.list_(pa.int32())
    types = [("shard", pa.int32()), ("term", pa.string()), ("block", pa.int32()), ("max_tf", pa.int32()), ("min_len", pa.int32()),
             ("ords", ints), ("tfs", ints), ("lens", ints)]
    return pa.Table.from_pylist(out, schema=pa.schema(types))


def test_early_stop_skips_postings_and_loses_nothing():
    """Few documents with rare words, many with one frequent word."""
    rng = random.Random(3)
    n = 20000
    length = [rng.choice([20, 50, 300]) for _ in range(n)]
    postings = {"the": [(i, rng.randint(1, 3), length[i]) for i in range(n) if rng.random() < 0.9]}
    for r in range(4):
        postings[f"rare{r}"] = [(i, rng.randint(1, 5), length[i]) for i in sorted(rng.sample(range(n), 60))]
    table = packed(postings, 128)
    terms, idfs = list(postings), np.array([0.05, 6.0, 5.5, 6.5, 5.0])
    shard = sh.ShardPostings(table, 60.0, 1.2, 0.75)
    ords, score, matched = shard.top(terms, idfs, 10)
    total, count = {}, {}
    for term, idf in zip(terms, idfs):
        for i, tf, size in postings[term]:
            total[i] = total.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / 60.0))
            count[i] = count.get(i, 0) + 1
    best = sorted(total, key=lambda i: (-round(total[i], 6), -count[i], i))[:10]
    assert ords.tolist() == best and matched.tolist() == [count[i] for i in best]
    np.testing.assert_allclose(score, [total[i] for i in best])
    assert shard.scored < 1500  # of some 18,000 postings
