import math

import pytest
from pyspark.sql import functions as F

from searchlake.functions.scoring import idf, term_score
from searchlake.operators import index as ix
from searchlake.operators import search as se
from searchlake.plans import catalog

SAMPLE = {
    "https://demo.local/java-concurrency": ("Java Concurrency", {"java": 4, "concurrency": 5, "threads": 3, "executor": 2}),
    "https://demo.local/distributed-crawling": ("Distributed Web Crawling", {"distributed": 4, "crawler": 5, "redis": 3, "frontier": 4, "recovery": 2}),
    "https://demo.local/bm25-search": ("BM25 Search Engine", {"search": 5, "engine": 3, "bm25": 4, "ranking": 3, "index": 2}),
}


def sample_index(spark, docs=SAMPLE):
    rows = [(u, sum(tf.values()), t, n) for u, (_, tf) in docs.items() for t, n in tf.items()]
    post = spark.createDataFrame(rows, "url string, doc_len int, term string, tf int")
    titles = spark.createDataFrame([(u, t) for u, (t, _) in docs.items()], "url string, title string")
    return ix.index_from_postings(post, "url", titles)


def test_corpus_stats(spark):
    c = sample_index(spark).corpus.first()
    assert (c.n_docs, c.n_terms, c.total_len) == (3, 14, 49)
    assert c.avgdl == pytest.approx(16.333333, abs=1e-6)


@pytest.mark.parametrize("query,expected", [
    ("distributed crawler", [("https://demo.local/distributed-crawling", 3.345840, 2)]),
    ("java concurrency", [("https://demo.local/java-concurrency", 3.478978, 2)]),
    ("search engine", [("https://demo.local/bm25-search", 3.257870, 2)]),
    ("search redis", [("https://demo.local/bm25-search", 1.729931, 1), ("https://demo.local/distributed-crawling", 1.508322, 1)]),
    ("", []),
    ("nothing here", []),
])
def test_sample_queries(spark, query, expected):
    res = se.search(sample_index(spark), query, 10, with_titles=True).orderBy("rank").collect()
    assert [(r.url, r.score, r.matched) for r in res] == expected
    for r in res:
        assert r.title == SAMPLE[r.url][0] and r.snippet == r.title


def test_higher_tf_ranks_first(spark):
    idx = sample_index(spark, {"a": ("", {"hello": 1, "world": 2}), "b": ("", {"hello": 3})})
    res = se.search(idx, "hello").orderBy("rank").collect()
    assert [(r.url, r.score) for r in res] == [("b", 0.286505), ("a", 0.182322)]


def test_formula_values(spark):
    df = spark.createDataFrame(
        [(100, 2, 3, 200, 200.0), (100, 80, 3, 200, 200.0), (10, 5, 4, 100, 150.0), (10, 5, 4, 400, 150.0)],
        "n long, df long, tf int, len int, avgdl double",
    )
    got = [round(r.s, 6) for r in df.select(term_score(idf("n", "df"), "tf", "len", "avgdl").alias("s")).collect()]
    assert got == [5.812447, 0.3565, 1.244836, 0.910402]
    assert got[0] > got[1] and got[2] > got[3]


def test_zero_cases(spark):
    df = spark.createDataFrame([(0, 1, 1, 1, 1.0), (10, 0, 1, 1, 1.0), (10, 1, 0, 1, 1.0), (10, 1, 1, 0, 1.0)],
                               "n long, df long, tf int, len int, avgdl double")
    assert [r.s for r in df.select(term_score(idf("n", "df"), "tf", "len", "avgdl").alias("s")).collect()] == [0.0] * 4
    one = spark.createDataFrame([(10, 1, 2, 5, 0.0)], "n long, df long, tf int, len int, avgdl double")
    s = one.select(term_score(idf("n", "df"), "tf", "len", "avgdl").alias("s")).first().s
    assert s == pytest.approx(math.log(1 + 9.5 / 1.5) * 2 * 2.2 / (2 + 1.2))


def test_parse_limit():
    assert [se.parse_limit(v) for v in ("5", None, "", "abc", " 5 ", "0", "1000", "+7", "99999999999")] == [5, 10, 10, 10, 10, 1, 100, 7, 10]


def test_batch_equals_single_queries(spark):
    idx = catalog.documents_index(spark, "/root/testdata/sf0.001")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").limit(3).collect()
    q = spark.createDataFrame([(r.item_id, r.text) for r in bench], "item_id long, text string")
    batch = se.search_batch(idx, q, 10, qid="item_id", text="text").collect()
    for r in bench:
        single = se.search(idx, r.text, 10).collect()
        got = sorted((x.doc_id, x.score, x.matched, x.rank) for x in batch if x.item_id == r.item_id)
        assert got == sorted((x.doc_id, x.score, x.matched, x.rank) for x in single)


def test_incremental_equals_rebuild(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    idx = ix.build_index(ix.text_tokens(docs, "doc_id", "text"), "doc_id")
    changed = docs.where(F.col("lang") == "fr").select(
        "doc_id", F.when(F.col("n_chars") > 1000, F.concat_ws(" ", "text", "text")).otherwise(F.lit("")).alias("text"))
    inc = ix.replace_documents(idx, ix.text_tokens(changed, "doc_id", "text"))
    v2 = docs.join(changed.withColumnRenamed("text", "t2"), "doc_id", "left").select(
        "doc_id", F.coalesce("t2", "text").alias("text"))
    full = ix.build_index(ix.text_tokens(v2, "doc_id", "text"), "doc_id")
    assert sorted(inc.term_stats.collect()) == sorted(full.term_stats.collect())
    cols = ["doc_id", "doc_len", "term", "tf"]
    assert sorted(inc.postings.select(cols).collect()) == sorted(full.postings.select(cols).collect())
    assert inc.corpus.first() == full.corpus.first()
    # invariants: sum df = postings rows, sum doc_len = total_len
    assert full.term_stats.agg(F.sum("df")).first()[0] == full.postings.count()
    assert full.doc_stats.agg(F.sum("doc_len")).first()[0] == full.corpus.first().total_len


def test_df_delta_both_paths(spark):
    ts = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "term string, df long")
    delta = spark.createDataFrame([("a", -1), ("b", -1), ("d", 2)], "term string, d long")
    expected = [("a", 2), ("c", 2), ("d", 2)]
    assert sorted(ix.apply_df_delta(ts, delta).collect()) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(ix.apply_df_delta(ts, delta).collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_batch_pushdown_matches_single(spark):
    idx = catalog.documents_index(spark, "/root/testdata/sf0.001")
    q = spark.createDataFrame([(1, "the of"), (2, "and with this"), (3, "")], "qid int, query string")
    batch = se.search_batch(idx, q, 5).collect()
    for qid, text in ((1, "the of"), (2, "and with this")):
        single = sorted((r.doc_id, r.score, r.matched, r.rank) for r in se.search(idx, text, 5).collect())
        assert sorted((r.doc_id, r.score, r.matched, r.rank) for r in batch if r.qid == qid) == single
    assert not [r for r in batch if r.qid == 3]


def test_joins_without_broadcast_give_same_results(spark):
    idx = catalog.documents_index(spark, "/root/testdata/sf0.001")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    keys = spark.createDataFrame([("the",), ("nosuchterm",)], "term string")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = ix.text_tokens(docs.where(F.col("lang") == "de").select("doc_id", F.lit("").alias("text")), "doc_id", "text")

    def run():
        return (
            sorted(se.search_batch(idx, bench, 5, qid="item_id", text="text", with_titles=True).select("item_id", "doc_id", "score", "rank").collect()),
            sorted(se.search(idx, "the of and", 5).collect()),
            sorted(ix.term_lookup(idx, keys).collect()),
            sorted(ix.replace_documents(idx, changed, materialize=False).term_stats.collect()),
        )

    small = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_read_only_the_partitions_of_their_keys(spark, tmp_path):
    from searchlake.sources import gold

    docs = spark.createDataFrame([(f"k{i}", f"common word{i} title") for i in range(500)], "k string, text string")
    built = ix.build_index(ix.text_tokens(docs, "k", "text", F.col("k")), "k")
    base = str(tmp_path / "g")
    gold.write_index(spark, built, base)
    for index in (built, gold.read_index(spark, base, "k")):
        found = se.search(index, "word7 word13", 10, with_titles=True)
        assert {(r["k"], r["title"]) for r in found.collect()} == {("k7", "k7"), ("k13", "k13")}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [doc_bucket" in plan and "PushedFilters: [In(k, [" in plan
        keys = spark.createDataFrame([("k3",), ("nosuch",), ("k3",), (None,)], "k string")
        got = ix.doc_lookup(index, keys)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(
            [("k3", 3, "k3", "k3"), ("k3", 3, "k3", "k3"), ("nosuch", 0, None, None), (None, 0, None, None)], key=repr
        )
        terms = spark.createDataFrame([("Common",), ("word9",), ("nosuch",)], "term string")
        assert sorted(map(tuple, ix.term_lookup(index, terms).collect())) == [("common", 500), ("nosuch", 0), ("word9", 1)]
    # Files read out of 64 partitions, from the scan's own count.
    few = ix.read_stats(spark, built.root, "doc_stats", built.doc_stats.schema, [3, 5])
    plan = few._jdf.queryExecution().executedPlan()
    few.collect()
    scan = plan.collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() <= 2
    assert len(list((tmp_path / "g").rglob("doc_stats/doc_bucket=*"))) > 50


