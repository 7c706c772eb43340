"""Index segments against full rebuilds, and what an upsert writes."""

import os

import pytest
from pyspark.sql import functions as F

from searchlake.operators import index as ix
from searchlake.operators import search as se
from searchlake.sources import bronze, gold, segments

SCHEMA = "k long, title string, text string"


def tok(spark, rows):
    return ix.text_tokens(spark.createDataFrame(rows, SCHEMA), "k", "text", F.col("title"))


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_size for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def tables(index):
    post = index.postings.select("k", "doc_len", "term", "tf")
    docs = index.doc_stats.select("k", "doc_len", "title", "snippet")
    corpus = index.corpus.select("n_docs", "n_terms", "total_len", "avgdl")
    return [sorted(map(tuple, t.collect()), key=repr) for t in (post, docs, index.term_stats.select("term", "df"), corpus)]


BATCHES = [
    [(i, f"t{i}", f"common word{i} word{i % 5} first") for i in range(40)] + [(None, "none", "null key common")],
    [(3, "new", "common second version"), (4, "gone", ""), (41, None, "fresh words"), (None, "none", "other words")],
    [(3, "newest", "third version common"), (7, "t7", "common again again"), (4, "back", "back again")],
    [(k, "x", "") for k in range(20, 30)],
    [],
    [(41, " ", "fresh words")],
    [(3, "", "!!"), (50, "fifty", "word1 word2 word3")],
]


@pytest.mark.parametrize("fan", [2, 100])
def test_segments_equal_a_full_rebuild(spark, tmp_path, fan):
    base, state = str(tmp_path / "gold"), {}
    for n, batch in enumerate(BATCHES):
        now = segments.apply(spark, base, tok(spark, batch), "k", n, fan)
        state |= {r[0]: r for r in batch}
    assert len(now.segments) <= (len(BATCHES) if fan == 100 else 4)
    got = gold.read_index(spark, base, "k")
    want = ix.build_index(tok(spark, list(state.values())), "k", materialize=False)
    assert tables(got) == tables(want)
    assert segments.current(spark, base) == now
    queries = spark.createDataFrame([(1, "common third again"), (2, "word1 fresh")], "qid int, query string")
    ranked = [sorted(map(tuple, se.search_batch(i, queries, 5).collect())) for i in (got, want)]
    assert ranked[0] == ranked[1]


def test_replacing_one_percent_writes_about_one_percent(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    base = str(tmp_path / "gold")
    old = segments.apply(spark, base, ix.text_tokens(docs, "doc_id", "text"), "doc_id")
    before = files(base)
    changed = docs.where("doc_id % 100 = 5").select("doc_id", F.concat_ws(" ", "text", F.lit("changed")).alias("text"))
    new = segments.apply(spark, base, ix.text_tokens(changed, "doc_id", "text"), "doc_id")
    after = files(base)
    assert {f: after[f] for f in before} == before  # nothing older was touched
    total = old.segments[0].rows
    assert new.segments[1].rows < 0.03 * total
    # Most bytes of so small a segment are the ends of its 64 bucket files.
    postings = [sum(n for f, n in found.items() if "/postings/" in f) for found in (before, after)]
    assert postings[1] - postings[0] < 0.1 * postings[0]


def test_merge_rule_keeps_segments_few_and_rewrites_rarely():
    assert segments.merge_start([100]) is None
    assert segments.merge_start([10_000, 10, 10, 10]) is None
    assert segments.merge_start([10_000, 10, 10, 10, 10]) == 1
    assert segments.merge_start([10, 10, 10, 10]) == 0
    rows, written = [1_000_000], 0
    for _ in range(1000):
        rows.append(100)
        written += 100
        while (start := segments.merge_start(rows)) is not None:
            rows[start:] = [sum(rows[start:])]
            written += rows[-1]
    assert len(rows) < 20
    assert written < 8 * 100 * 1000
    assert sum(rows) == 1_100_000


def test_a_search_reads_only_the_buckets_of_its_terms(spark, tmp_path):
    """The buckets are pruned in every segment."""
    base = str(tmp_path / "gold")
    for n, batch in enumerate(BATCHES[:3]):
        segments.apply(spark, base, tok(spark, batch), "k", n, 100)
    idx = gold.read_index(spark, base, "k")
    plan = ix.posting_list(idx, "common")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(term_bucket") == 3
    assert {r["k"] for r in ix.posting_list(idx, "Common").collect()} == ({None, *range(40)} | {3}) - {4, None}


def test_bronze_rewrites_only_touched_buckets(spark, tmp_path):
    base = str(tmp_path / "bronze")
    rows = [(f"https://h/{i}", f"<p>{i}</p>", 200, "text/html", {"a": "b"}) for i in range(200)]
    day = "2026-01-0{} 00:00:00"

    def records(rows, n):
        return bronze.bronze_records(spark.createDataFrame(rows, bronze.FETCHED_SCHEMA), F.lit(day.format(n)).cast("timestamp"))

    bronze.upsert_bronze(spark, records(rows, 1), base, buckets=16)
    before = files(base)
    assert len({f.split("/bucket=")[1].split("/")[0] for f in before}) == 16
    again = [(rows[5][0], "<p>newer</p>", 200, "text/html", None), (rows[5][0], "<p>newest</p>", 200, "text/html", None)]
    bronze.upsert_bronze(spark, records(again[:1], 2).unionByName(records(again[1:], 3)), base)
    after = files(base)
    assert {f: after[f] for f in before} == before
    assert len({f.split("/bucket=")[1].split("/")[0] for f in after.keys() - before.keys()}) == 1
    assert sum(after[f] for f in after.keys() - before.keys()) < 0.2 * sum(before.values())
    # An older fetch that comes late doesn't win.
    bronze.upsert_bronze(spark, records([(rows[5][0], "<p>late</p>", 200, "text/html", None)], 2), base)
    got = {r["url"]: r["html"] for r in bronze.read_bronze(spark, base).collect()}
    assert got == {u: h for u, h, *_ in rows} | {rows[5][0]: "<p>newest</p>"}
    key = spark.range(1).select(F.substring(F.sha2(F.lit(rows[5][0]), 256), 1, 16)).first()[0]
    one = bronze.read_bronze_ids(spark, base, [key])
    assert [r["html"] for r in one.collect()] == ["<p>newest</p>"] and len(one.inputFiles()) < 5
    bronze.upsert_bronze(spark, records([], 4), base)
    assert bronze.read_bronze(spark, base).count() == 200
