"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.llm import (
    bpe, conversation_repair, decontaminate, fingerprint, language_id, lm_score, near_dedup, oracle, quality, sharding,
    token_count, toxicity, url_filter, vector_codes,
)
from searchlake.llm.common import bounded_batches
from searchlake.sources.tables import read_table

SHARDS = 40
UNIGRAM_PATH = public_tokenizers.path("piece_bpe_32k.model")
BPE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Fixed values of the task: host, path and verdict of the URL rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents."""
    return lm_score.score(read_table(spark, sf_dir, "documents"))


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 39 by jump consistent hash of doc_id."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)


def op3_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under the unigram view of a public vocabulary."""
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), UNIGRAM_PATH)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and next documents,
    classes of equal texts and verified links."""
    return fingerprint.with_links(read_table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).drop("n_links")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to ids, and the ids decoded."""
    out = bpe.encode(read_table(spark, sf_dir, "documents"), BPE_PATH, public_tokenizers.PATTERN, decode=True)
    return bpe_digests(out)


def bpe_digests(encoded: DataFrame) -> DataFrame:
    """Lengths and SHA-256 digests of encoded and decoded texts."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by the rule list."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(read_table(spark, sf_dir, "pages"), rules)


def op9_quality_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of all documents under the model of trusted text."""
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    out = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the task says, and repaired."""
    rows = conversation_repair.damaged(read_table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, copies_col="copies")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings."""
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_masked_lm": op1_masked_lm,
    "op2_jump_shards": op2_jump_shards,
    "op3_toxicity_cnn": op3_toxicity_cnn,
    "op4_token_counts": op4_token_counts,
    "op5_minhash": op5_minhash,
    "op6_near_dedup": op6_near_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_url_filter": op8_url_filter,
    "op9_quality_kn": op9_quality_kn,
    "op10_decontaminate": op10_decontaminate,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_language_id": op12_language_id,
    "op13_vector_codes": op13_vector_codes,
}

QUERIES = {name: _bounded(query) for name, query in QUERIES.items()}

ORACLE: dict[str, str] = {
    "op2_jump_shards": oracle.OP2,
    "op6_near_dedup": oracle.OP6,
    "op8_url_filter": oracle.OP8,
    "op10_decontaminate": oracle.OP10,
    "op11_conversation_repair": oracle.OP11,
    "op13_vector_codes": oracle.OP13,
}
