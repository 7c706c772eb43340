"""Fetch-log analytics re-aimed from the HTTP client and the shared queue:
accept filter (P2), header flattening (P3), attempt resolution (L1),
backoff accounting (L2) and lease recovery (L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.constants import HTML_CONTENT_TYPES, INITIAL_BACKOFF_MS, MAX_BACKOFF_EXPONENT, MAX_FETCH_ATTEMPTS
from searchlake.operators.scan import next_value_min


def accepted(status, content_type) -> F.Column:
    """2xx and an HTML content type (case-sensitive; missing = '')."""
    s = F.col(status) if isinstance(status, str) else status
    ct = F.coalesce(F.col(content_type) if isinstance(content_type, str) else content_type, F.lit(""))
    html = F.lit(False)
    for t in HTML_CONTENT_TYPES:
        html = html | ct.contains(t)
    return F.coalesce((s >= 200) & (s < 300) & html, F.lit(False))


def flatten_headers(headers) -> F.Column:
    """``map<string, array<string>>`` -> values joined with ', '."""
    h = F.col(headers) if isinstance(headers, str) else headers
    return F.transform_values(h, lambda k, v: F.array_join(v, ", "))


def retryable(status) -> F.Column:
    """429, >= 500 and I/O errors (NULL status) are retried."""
    s = F.col(status) if isinstance(status, str) else status
    return s.isNull() | (s == 429) | (s >= 500)


def backoff_ms(attempt, initial_ms: int = INITIAL_BACKOFF_MS) -> F.Column:
    """L2: wait after attempt a = initial * 2^min(a-1, 10)."""
    a = F.col(attempt) if isinstance(attempt, str) else attempt
    return (F.lit(initial_ms) * F.pow(F.lit(2), F.least(a - 1, F.lit(MAX_BACKOFF_EXPONENT)))).cast("long")


def resolve_attempts(log: DataFrame, url: str = "url", max_attempts: int = MAX_FETCH_ATTEMPTS) -> DataFrame:
    """L1 + L2: per URL ``(url, attempts, final_status, accepted, backoff_ms)``;
    ``final_status`` 0 means the final attempt got no HTTP status (I/O error).

    Attempts beyond ``max_attempts`` are ignored.  The final attempt is the
    first non-retryable one or the last allowed one; if the log ends before
    either, the last logged attempt counts as final.  Backoff is summed over
    the attempts before the final one.  One grouped pass with partial
    aggregation (at most ``max_attempts`` rows per URL survive the filter).
    """
    a = log.where(F.col("attempt") <= max_attempts)
    terminal = ~retryable("status") | (F.col("attempt") == max_attempts)
    rec = F.struct(F.col("attempt"), F.col("status"), F.col("contentType"))
    g = a.groupBy(F.col(url).alias("url")).agg(
        F.min_by(rec, F.when(terminal, F.col("attempt"))).alias("term"),
        F.max_by(rec, F.col("attempt")).alias("last"),
    )
    fin = F.coalesce(F.col("term"), F.col("last"))
    out = g.select(
        "url",
        fin["attempt"].cast("int").alias("attempts"),
        F.coalesce(fin["status"], F.lit(0)).cast("int").alias("final_status"),
        accepted(fin["status"], fin["contentType"]).alias("accepted"),
        F.aggregate(
            F.sequence(F.lit(1), fin["attempt"].cast("int")),
            F.lit(0).cast("long"),
            lambda acc, x: acc + F.when(x < fin["attempt"], backoff_ms(x)).otherwise(F.lit(0).cast("long")),
        ).alias("backoff_ms"),
    )
    return out


def lease_recovery(task_events: DataFrame, lease_ms: int, task: str = "task", ts_ms: str = "ts_ms", eid: str = "id") -> DataFrame:
    """L3: polls whose lease ran out: ``(task, poll_ms, recover_ms, late_finish)``.

    For every poll the next ``finish`` of the same task after it is
    found with a chunked descending scan (no task is gathered in one task);
    if there is none, or it comes later than poll + lease, the task goes
    back to the queue at poll + lease (at-least-once delivery: a later
    finish then counts as a duplicate delivery).
    """
    ev = task_events.where(F.col("kind").isin("poll", "finish"))
    fin = F.when(F.col("kind") == "finish", F.col(ts_ms))
    # 'finish' sorts before 'poll' at equal time, so a finish at the poll's
    # own timestamp does not count as after it.
    order = [F.col(ts_ms), F.when(F.col("kind") == "finish", 0).otherwise(1), F.col(eid)]
    ev = ev.withColumn("_fin", fin)
    nxt = next_value_min(ev, task, order, "_fin", "finish_ms")
    polls = nxt.where(F.col("kind") == "poll")
    expired = F.col("finish_ms").isNull() | (F.col("finish_ms") > F.col(ts_ms) + F.lit(lease_ms))
    return polls.where(expired).select(
        F.col(task).alias("task"),
        F.col(ts_ms).alias("poll_ms"),
        (F.col(ts_ms) + F.lit(lease_ms)).cast("long").alias("recover_ms"),
        F.col("finish_ms").isNotNull().alias("late_finish"),
    )
