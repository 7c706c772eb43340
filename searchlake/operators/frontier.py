"""Crawl frontier over a link table: dedup (J4), bounded BFS (G2) and
frontier counters (G3).

The BFS is a short driver loop of at most ``max_depth`` rounds; every round
is a distributed join.  The edges are stored once and each round's
new level after it, in the shared scratch folder, which keeps lineage flat and
survives executor loss; the visited set is the union of the stored levels.
No partitioning is fixed, so adaptive execution may broadcast a small frontier
(the edges are then only streamed) and splits a hub's edges in a shuffle join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.constants import DEFAULT_MAX_DEPTH
from searchlake.functions import urls
from searchlake.operators.robots import filter_links
from searchlake.operators.scan import running_total
from searchlake.session import stored


def offer(candidates: DataFrame, visited: DataFrame, url: str = "url", depth: str = "depth") -> DataFrame:
    """URLs scheduled from a batch of offers: one row per URL never
    seen before, at its smallest offered depth (duplicates collapse in the
    partial aggregate before the shuffle)."""
    best = candidates.groupBy(F.col(url).alias("url")).agg(F.min(depth).alias("depth"))
    return best.join(visited.select(F.col(url).alias("url")), "url", "left_anti")


def bfs(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = DEFAULT_MAX_DEPTH,
    max_pages: int | None = None,
    fetchable: DataFrame | None = None,
    admitted: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(url, depth, fetched)`` for every URL offered by a breadth-first
    crawl from ``seeds`` (depth 0).

    A URL is *fetched* when it is in ``fetchable`` (all URLs when None); only
    fetched URLs with depth < ``max_depth`` expand their links.  With
    ``max_pages`` the crawl takes fetched pages in (depth, url) order and
    stops at that many; pages beyond the cap are not fetched and their links
    not expanded (the cap is the feature, applied as a bounded top-k).
    ``admitted`` is a filter of ``(url)`` rows: only URLs that pass it are
    offered by a link, and fetched.  It sees each round's new URLs, not links.
    """
    e = stored(edges.select("src", "dst"), "edges")
    ok = stored(fetchable.select(F.col("url")).distinct(), "fetchable") if fetchable is not None else None

    def mark(frontier: DataFrame) -> DataFrame:
        if ok is None:
            return frontier.withColumn("fetched", F.lit(True))
        hit = frontier.select("url").join(ok, "url", "left_semi")
        # Stored first: else Spark moves the filter down, to all of ``ok``.
        hit = (admitted(stored(hit, "hit")) if admitted else hit).select("url", F.lit(True).alias("fetched"))
        return frontier.join(hit, "url", "left").withColumn("fetched", F.coalesce("fetched", F.lit(False)))

    # Seeds are normalised like discovered links, so "http://x" and
    # "http://x/" are one URL (values that are not URLs pass unchanged).
    seed_urls = seeds.select(urls.normalize("url").alias("url")).distinct()
    level = stored(mark(seed_urls.withColumn("depth", F.lit(0))), "level")
    visited = level
    taken = 0
    for d in range(max_depth + 1):
        if max_pages is not None:
            n_fetched = level.where("fetched").count()
            if taken + n_fetched >= max_pages:
                remaining = max_pages - taken
                keep = level.where("fetched").orderBy("url").limit(remaining).select("url", F.lit(True).alias("keep"))
                capped = level.join(stored(keep, "keep"), "url", "left").select(
                    "url", "depth", (F.col("fetched") & F.col("keep").isNotNull()).alias("fetched")
                )
                visited = visited.where(F.col("depth") < d).unionByName(capped)
                break
            taken += n_fetched
        if d == max_depth:
            break
        expand = level.where("fetched").select(F.col("url").alias("src"))
        nxt = expand.join(e, "src").select(F.col("dst").alias("url")).distinct()
        nxt = nxt.join(visited.select("url"), "url", "left_anti")
        nxt = admitted(stored(nxt, "found")) if admitted else nxt
        level = stored(mark(nxt).withColumn("depth", F.lit(d + 1)), "level")
        if level.isEmpty():
            break
        # A union of stored levels: the lineage stays one level deep.
        visited = visited.unionByName(level)
    return visited.select("url", F.col("depth").cast("int").alias("depth"), "fetched")


def crawl(
    edges: DataFrame,
    seeds: DataFrame,
    rules: DataFrame,
    allowed_domain: str | None,
    fetchable: DataFrame,
    max_depth: int = DEFAULT_MAX_DEPTH,
    max_pages: int | None = None,
) -> DataFrame:
    """G2 as the crawler composes it: ``bfs`` where a link is offered only if
    its target passes the domain filter (P5) and robots (J3), and a page is
    taken only if it passes both and is fetchable (present and accepted)."""
    rules = stored(rules, "rules")
    return bfs(edges, seeds, max_depth, max_pages, fetchable, lambda found: filter_links(found, rules, allowed_domain, "url"))


def frontier_timeline(log: DataFrame, url: str, kind: str, ts_ms: str, bucket_ms: int) -> DataFrame:
    """G3 over an event log of offers, polls and finishes: per time bucket
    ``(bucket, queued, visited, in_flight, idle)`` at its end.

    A URL is visited and queued by its first offer; a poll takes a task from
    the queue and a finish ends it.  The queue is idle when nothing is queued
    or in flight.  Deltas are summed per bucket first; the running totals are a
    chunked scan over the ordered buckets, so no task sees them all."""
    rows = log.select(F.col(url).alias("u"), F.col(kind).alias("k"), F.col(ts_ms).alias("t")).where(F.col("t").isNotNull())
    first = rows.where("k = 'offer'").groupBy("u").agg(F.min("t").alias("t")).select("t", F.lit(1).alias("v"), F.lit(0).alias("p"), F.lit(0).alias("e"))
    moves = rows.where("k in ('poll', 'finish')").select(
        "t", F.lit(0).alias("v"), (F.col("k") == "poll").cast("int").alias("p"), (F.col("k") == "finish").cast("int").alias("e")
    )
    deltas = first.unionByName(moves).groupBy(F.floor(F.col("t") / F.lit(bucket_ms)).cast("long").alias("bucket")).agg(
        *[F.sum(c).alias(c) for c in ("v", "p", "e")]
    )
    deltas = stored(deltas.withColumn("all", F.lit(0)), "frontier-deltas")
    out = deltas
    for c in ("v", "p", "e"):
        out = running_total(out, "all", [F.col("bucket")], c, f"run_{c}")
    queued, flying = F.col("run_v") - F.col("run_p"), F.col("run_p") - F.col("run_e")
    return out.select(
        "bucket", queued.alias("queued"), F.col("run_v").alias("visited"), flying.alias("in_flight"),
        ((queued <= 0) & (flying <= 0)).alias("idle"),
    )


def frontier_counts(visited: DataFrame) -> DataFrame:
    """Per depth, URLs offered and pages fetched."""
    return visited.groupBy("depth").agg(
        F.count(F.lit(1)).alias("n_offered"),
        F.sum(F.col("fetched").cast("long")).alias("n_fetched"),
    )
