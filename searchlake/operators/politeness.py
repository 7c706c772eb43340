"""Per-host politeness schedule.

Requests to one host are served at least ``delay`` apart, first come first
served by (arrival, id):  grant_i = max(arrival_i, grant_{i-1} + delay).
Unrolled, with i the 1-based position inside the host,

    grant_i = i*delay + max_{j<=i}(arrival_j - j*delay)

so the schedule is a running max -- computed here with the skew-safe chunked
scan, so a host that holds a third of all requests is still spread over
many tasks.  Requests without host are not delayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.constants import DEFAULT_POLITENESS_DELAY_MS
from searchlake.operators.scan import chunk_rows, local_window


def schedule(
    requests: DataFrame,
    host: str = "host",
    arrival_ms: str = "arrival_ms",
    rid: str = "id",
    delay_ms: int = DEFAULT_POLITENESS_DELAY_MS,
    partitions: int | None = None,
    last: DataFrame | None = None,
) -> DataFrame:
    """``requests`` plus ``grant_ms`` and ``wait_ms`` (= grant - arrival).

    ``last(<host>, last_ms)`` has the last grant of hosts that were served
    before: their first request here waits for it plus the delay."""
    order = [F.col(arrival_ms), F.col(rid)]
    hosted = requests.where(F.col(host).isNotNull())
    c = chunk_rows(hosted, host, order, partitions)
    v_local = F.col(arrival_ms) - F.col("_k") * F.lit(delay_ms)
    c = c.withColumn("_v", v_local).withColumn("_run", F.max("_v").over(local_window(host, order)))
    summary = c.groupBy(host, "_chunk").agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_cmax"))
    summary = _prefix(summary, host, delay_ms)
    if last is not None:
        # An earlier grant is position 0 of its host's order.
        summary = summary.join(last.select(host, "last_ms"), host, "left").withColumn("_prev", F.greatest("_prev", "last_ms"))
    # The summary has one row per (host, chunk); AQE turns this join into a
    # broadcast at run time when its measured size is small.
    summary = summary.select(host, "_chunk", "_off", "_prev")
    j = c.join(summary, [host, "_chunk"])
    i = F.col("_off") + F.col("_k")
    best = F.greatest(F.col("_run") - F.col("_off") * F.lit(delay_ms), F.coalesce("_prev", F.col("_run") - F.col("_off") * F.lit(delay_ms)))
    grant = i * F.lit(delay_ms) + best
    hosted_out = j.select(*requests.columns, grant.cast("long").alias("grant_ms"))
    unhosted = requests.where(F.col(host).isNull()).withColumn("grant_ms", F.col(arrival_ms).cast("long"))
    out = hosted_out.unionByName(unhosted)
    return out.withColumn("wait_ms", (F.col("grant_ms") - F.col(arrival_ms)).cast("long"))


def _prefix(summary: DataFrame, host: str, delay_ms: int) -> DataFrame:
    """Chunk c's values in global numbering are its local values shifted by
    -off_c*delay; ``_prev`` is the max of that over all earlier chunks."""
    from pyspark.sql import Window

    w = Window.partitionBy(host).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    s = summary.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    s = s.withColumn("_gmax", F.col("_cmax") - F.col("_off") * F.lit(delay_ms))
    return s.withColumn("_prev", F.max("_gmax").over(w))
