"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  Every query is executed in
full with the ``noop`` sink (no driver collection).  ``index_build`` is
timed on its own; the search queries then reuse that index, as a search
service would.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bm25_search",
    "bm25_batch_topk",
    "term_freq",
    "page_terms",
    "page_links",
    "robots_allowed",
    "links_allowed",
    "bfs_depth",
    "politeness_schedule",
    "fetch_attempts",
    "lease_recovery",
    "latency_percentiles",
    "index_replace",
    "index_export",
    "crawl_summary",
    "pipeline_counts",
    "page_search",
    "stream_lease",
]


def main() -> None:
    from searchlake.plans import catalog
    from searchlake.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))), "spark.driver.memory": "16g"},
    )
    times: dict[str, float] = {}

    t0 = time.perf_counter()
    idx = catalog.documents_index(spark, sf_dir)
    idx.postings.write.format("noop").mode("overwrite").save()
    times["index_build"] = round(time.perf_counter() - t0, 3)

    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    n_queries = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").count()
    qps = round(n_queries / max(times["bm25_batch_topk"], 1e-6), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "batch_queries_per_sec": qps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
