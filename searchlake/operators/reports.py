"""Report aggregates: latency percentiles (A8), request metrics (A9), crawl
summary (A6) and pipeline stage counts (A7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.constants import LATENCY_PERCENTILES
from searchlake.operators.scan import running_total
from searchlake.session import one_row


def epoch_ms(ts) -> F.Column:
    """Milliseconds since 1970 of a TIMESTAMP_NTZ / TIMESTAMP column,
    independent of the session time zone for zone-less values."""
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz"))
    return F.floor(micros / 1000).cast("long")


def latency_report(df: DataFrame, group: str, value: str, ts_ms: str, percentiles=LATENCY_PERCENTILES) -> DataFrame:
    """Per group ``n``, nearest-rank percentiles and ``qps``.

    Nearest rank: the sorted value at 1-based rank ceil(p*n) clamped to
    [1, n].  Equal values are counted first (latencies are often tied), then
    a chunked running total of the counts ranks the distinct values, so this
    is exact and neither a group nor a value is gathered in one task; qps =
    n / max(seconds between first and last request, 1e-6).  Null values
    count in ``n`` and rank first.
    """
    stats = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        ((F.max(ts_ms) - F.min(ts_ms)) / 1000.0).alias("elapsed_s"),
    )
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_times"))
    ranked = running_total(counts, group, [F.col(value)], "_times", "_idx")
    names = [f"p{int(round(p * 100))}" for p in percentiles]
    targets = stats
    for p, name in zip(percentiles, names):
        r = F.greatest(F.lit(1), F.least(F.col("n"), F.ceil(F.lit(float(p)) * F.col("n"))))
        targets = targets.withColumn("_r_" + name, r.cast("long"))
    j = ranked.join(targets.select(group, *["_r_" + n for n in names]), group)
    # A value covers the ranks above the total before it, up to its own.
    covers = {n: (F.col("_r_" + n) > F.col("_idx") - F.col("_times")) & (F.col("_r_" + n) <= F.col("_idx")) for n in names}
    chosen = j.groupBy(group).agg(*[F.max(F.when(c, F.col(value))).alias(n) for n, c in covers.items()])
    qps = F.round(F.col("n") / F.greatest(F.col("elapsed_s"), F.lit(1e-6)), 6)
    return stats.join(chosen, group).select(group, "n", *names, qps.alias("qps"))


def request_metrics(log: DataFrame, ts_ms: str, took_ms: str, bucket_ms: int = 3_600_000) -> DataFrame:
    """Per time bucket the request count and the timer's count / total / max."""
    b = F.floor(F.col(ts_ms) / F.lit(bucket_ms)).cast("long")
    return log.groupBy(b.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.round(F.sum(took_ms), 6).alias("total_ms"),
        F.max(took_ms).alias("max_ms"),
    )


def crawl_summary(bronze: DataFrame, visited: DataFrame, silver: DataFrame, index_docs: DataFrame, n_terms: DataFrame) -> DataFrame:
    """Pages stored, URLs discovered, Silver/Gold documents, terms,
    elapsed ms (first to last fetch) and pages/s = pages / max(s, 0.001).
    Every input is reduced to one row before the cross join."""
    b = bronze.agg(
        F.count(F.lit(1)).alias("pages_stored"),
        (F.max("fetched_ms") - F.min("fetched_ms")).alias("elapsed_ms"),
    )
    v = one_row(visited.agg(F.count(F.lit(1)).alias("urls_discovered")))
    s = one_row(silver.agg(F.count(F.lit(1)).alias("silver_docs")))
    g = one_row(index_docs.agg(F.count(F.lit(1)).alias("gold_docs")))
    t = one_row(n_terms.agg(F.count(F.lit(1)).alias("terms")))
    out = b.crossJoin(v).crossJoin(s).crossJoin(g).crossJoin(t)
    pps = F.col("pages_stored") / F.greatest(F.coalesce(F.col("elapsed_ms"), F.lit(0)) / 1000.0, F.lit(0.001))
    return out.select(
        "pages_stored", "urls_discovered", "silver_docs", "gold_docs", "terms",
        F.coalesce("elapsed_ms", F.lit(0)).cast("long").alias("elapsed_ms"),
        F.round(pps, 6).alias("pages_per_second"),
    )
