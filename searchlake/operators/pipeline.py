"""Bronze -> Silver -> Gold pipeline run with stage counts.

Counts come from ``DataFrame.observe`` on the writes themselves, so no stage
is scanned a second time just to count it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from searchlake.operators import index as ix
from searchlake.operators.fetchlog import accepted
from searchlake.operators.pages import parse_pages, silver_documents
from searchlake.session import materialize
from searchlake.sources.bronze import keep_latest
from searchlake.sources.silver import silver_postings


@dataclass(frozen=True)
class PipelineStats:
    silver_documents: int
    gold_documents: int


def run_pipeline(spark: SparkSession, bronze: DataFrame, silver_path: str, gold_path: str) -> tuple[PipelineStats, ix.Index]:
    """Keep the latest Bronze row per id, parse accepted pages to Silver,
    write it (counted by an observation on the write), then build and write
    the Gold index from the written Silver term maps; the Gold count is the
    corpus row of the written index."""
    latest = keep_latest(bronze, "id", "fetchedAt")
    # Term maps and metadata both derive from the parse: parse the HTML once.
    parsed = materialize(
        parse_pages(latest.where(accepted("statusCode", "contentType"))).select("url", "title", "links", "toks", "doc_len")
    )
    silver_obs = Observation("silver")
    # sourceBronzeId = url id of the page, which is the Bronze id by construction.
    silver = silver_documents(parsed, processed_at=F.current_timestamp())
    silver.observe(silver_obs, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(silver_path)

    written = spark.read.parquet(silver_path)
    # Gold postings come from the written Silver term maps (P7: documents
    # without terms produce no posting; mixed-case terms are folded).
    post = silver_postings(written, "url")
    idx = ix.write_gold(post, "url", written.select("url", "title"), gold_path)
    # One-row corpus table of the written index.
    n_gold = idx.corpus.first()["n_docs"]
    return PipelineStats(silver_obs.get["n"], n_gold), idx
