"""The corpus pipeline against brute force, stage by stage."""

import hashlib

import public_tokenizers
import tiktoken

import __spark_entry__
import corpus_pipeline
from searchlake.llm import bpe, quality, toxicity
from searchlake.llm.queries import BPE_PATH
from searchlake.sources.tables import read_table
from test_near_and_windows import brute, hits

SF = "/root/testdata/sf0.001"


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_and_run(spark, tmp_path):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, frames[-1], SF).write.parquet(path)
        frames.append(spark.read.parquet(path))
    for kept in frames[1:-1]:
        assert kept.columns == docs.columns
    start, good, clean, unique, free, tokens = frames

    assert ids(good) == ids(quality.classify(start, labels).where("not rejected"))
    assert ids(clean) == ids(toxicity.classify(good, labels).where("not flagged"))
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert ids(unique) == {d for d, _, c in brute(rows) if d == c}
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    texts = {r["doc_id"]: r["text"] for r in unique.collect()}
    assert ids(free) == {d for d, t in texts.items() if not hits(t, items)[1]}
    assert 0 < free.count() < docs.count()

    with open(BPE_PATH, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for r in free.collect():
        own = library.encode_ordinary(r["text"])
        want[r["doc_id"]] = (len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in tokens.collect()} == want
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(tokens.collect())


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        kept = docs
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, SF)
        assert kept.count() == (0 if docs is no_docs else kept.count())
        assert set(kept.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
