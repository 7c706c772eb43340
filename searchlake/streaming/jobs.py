"""Structured Streaming versions of the incremental stages (ST1-ST5).

Every job reads a file source with an explicit schema, keeps its progress
in a checkpoint location (exactly-once with the file sink / idempotent
foreachBatch), and can run continuously or with ``availableNow``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.constants import DEFAULT_POLITENESS_DELAY_MS
from searchlake.functions import urls
from searchlake.operators import politeness
from searchlake.operators.pages import page_columns
from searchlake.session import stored
from searchlake.sources import bronze, segments


# --- ST1: Bronze -> Silver, stateless ----------------------------------------------

def silver_stream(bronze_stream: DataFrame, key: str = "url", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """ST1: parse each arriving page (T6) -- stateless, append mode."""
    parsed = page_columns(bronze_stream, key, html, keep)
    return parsed.select(*keep, "url", urls.url_id("url").alias("id"), "title", "links", F.size("toks").cast("int").alias("doc_len"))


#: The state of a join that holds whole texts: in RocksDB, with bounded memory
#: for all stores of an executor, one store a partition instead of four, and no
#: disk that is not yet written.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def bronze_files_stream(meta: DataFrame, html: DataFrame, span: str) -> DataFrame:
    """S2/J6 for files that arrive apart: ``BRONZE_COLUMNS`` and ``named`` for
    each record of ``meta`` (META_SCHEMA and ``at``) and each body of
    ``html(file_id, html, at)`` that is its own, as soon as both are there.

    ``at`` is the arrival; a record and its body meet if they arrive within
    ``span`` of each other, and state older than that is dropped with the
    watermark.  A record whose named file and own file are both there comes
    out twice; ``bronze.best_bodies`` takes the named one."""
    named = F.col("name") != ""
    files = F.array(F.struct(F.col("name").alias("f"), F.lit(True).alias("n")), F.struct(F.col("id").alias("f"), F.lit(False).alias("n")))
    records = meta.withWatermark("at", span).withColumn("name", bronze.named_file("htmlPath"))
    wanted = records.withColumn("w", F.explode(F.when(named & (F.col("name") != F.col("id")), files).otherwise(F.slice(files, 2, 1))))
    wanted = wanted.select(*[c for c in bronze.BRONZE_COLUMNS if c != "html"], F.col("w.f").alias("wanted"), F.col("w.n").alias("named"), F.col("at").alias("seen"))
    bodies = html.select("file_id", "html", F.col("at").alias("came")).withWatermark("came", span)
    step = F.expr(f"INTERVAL {span}")
    near = (F.col("came") >= F.col("seen") - step) & (F.col("came") <= F.col("seen") + step)
    return wanted.join(bodies, (F.col("wanted") == F.col("file_id")) & near).select(*bronze.BRONZE_COLUMNS, "named")


def _latest(batch: DataFrame, key: str) -> DataFrame:
    """W5 within a micro-batch: one row per key, the latest by ``fetched_ms``;
    ties (or no such column) by title and tokens, so a replay keeps the same."""
    cols = [c for c in batch.columns if c != key]
    order = [c for c in ("fetched_ms", "title", "toks") if c in cols]
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("_b")
    return batch.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in cols if c != "fetched_ms"])


# --- ST2: Silver -> Gold upsert with foreachBatch ----------------------------------

def gold_upsert_batch(spark: SparkSession, gold_base: str, key: str):
    """A ``foreachBatch`` function: the micro-batch (tokenized rows
    ``(<key>, title, toks)``, with ``fetched_ms`` the latest of a key's rows
    wins) replaces those documents by one more index segment (J5), and the
    new list of segments is published with the batch id.  A replay of a
    published batch is a no-op; an attempt that died before publishing is
    redone in a fresh folder."""

    def run(batch: DataFrame, batch_id: int) -> None:
        cur = segments.current(spark, gold_base)
        if cur is None or cur.batch != batch_id:
            segments.apply(spark, gold_base, _latest(batch, key), key, batch_id)

    return run


# --- ST3: URL de-duplication ---------------------------------------------------------

def dedup_stream(
    offers: DataFrame, url: str | list[str] = "url", event_time: str = "ts", delay: str = "1 hour", exact: bool = False
) -> DataFrame:
    """ST3: first offer of a URL wins.

    Default: state bounded by the watermark (a URL offered again after the
    watermark passed its first offer is let through again, and offers later
    than the watermark are dropped -- the late-data rule).  ``exact`` keeps
    every URL ever seen in streaming state, like an unbounded visited set;
    ``visited_batch`` keeps them in a table instead."""
    keys = [url] if isinstance(url, str) else url
    if exact:
        return offers.dropDuplicates(keys)
    return offers.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


#: Buckets of the visited table, and 64-bit words of its bitmap (1 MiB).
VISITED_BUCKETS, VISITED_WORDS = 64, 1 << 17


def _read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def visited_batch(spark: SparkSession, base: str, url: str = "url"):
    """ST3, exact: a ``foreachBatch`` function that adds each URL to a visited
    table the first time it is offered; streaming state stays empty.

    ``base/visited/batch=N`` holds the URLs that batch N brought, in hash
    buckets: it is the result and the memory.  ``base/bits`` is a bitmap of
    fixed size over all of them.  A URL whose bit is not set is new without a
    look at the table; the others are anti-joined with the buckets concerned.
    A batch that is run again reads only earlier batches and replaces its own
    folders, so nothing is lost or doubled.  A null URL is no offer."""
    root = base.rstrip("/")
    visited_schema, bits_schema = f"`{url}` string, batch long, bucket int", "at int, bits long, batch long"

    def run(batch: DataFrame, batch_id: int) -> None:
        h = F.xxhash64(url)
        offers = batch.select(F.col(url)).where(F.col(url).isNotNull()).distinct().select(
            url, F.pmod(h, F.lit(VISITED_BUCKETS)).cast("int").alias("bucket"),
            F.pmod(F.shiftrightunsigned(h, 6), F.lit(VISITED_WORDS)).cast("int").alias("at"),
            F.shiftrightunsigned(h, 58).cast("int").alias("bit"),
        )
        earlier = _read_if_there(spark, f"{root}/bits", bits_schema).where(F.col("batch") < batch_id)
        last = earlier.agg(F.max("batch")).first()[0]
        bits = earlier.where(F.col("batch") == F.lit(last)).select("at", "bits")
        marked = offers.join(F.broadcast(bits), "at", "left")  # VISITED_WORDS rows at most
        marked = stored(marked.withColumn("maybe", F.coalesce(F.getbit("bits", F.col("bit")) == 1, F.lit(False))).drop("bits"), "offers")
        known = _read_if_there(spark, f"{root}/visited", visited_schema).where((F.col("batch") < batch_id) & (F.col("bucket") >= 0))
        # Joined on the bucket too: only the buckets of the offers are read.
        unsure = marked.where("maybe").join(known.select("bucket", url), ["bucket", url], "left_anti")
        new = marked.where("not maybe").select(url, "bucket", "at", "bit").unionByName(unsure.select(url, "bucket", "at", "bit"))
        new.select(url, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/visited/batch={batch_id}")
        words = marked.select("at", F.expr("shiftleft(1L, bit)").alias("bits")).unionByName(bits)
        words.groupBy("at").agg(F.bit_or("bits").alias("bits")).write.mode("overwrite").parquet(f"{root}/bits/batch={batch_id}")

    return run


def read_visited(spark: SparkSession, base: str, url: str = "url") -> DataFrame:
    """The URLs of a visited table, each once."""
    return _read_if_there(spark, f"{base.rstrip('/')}/visited", f"`{url}` string, batch long, bucket int").select(url)


# --- ST4: lease expiry as an interval join ---------------------------------------------


def lease_stream(task_events: DataFrame, lease_ms: int, delay: str) -> DataFrame:
    """ST4: ``(task, poll_ms, recover_ms)`` of the polls whose lease expired.

    Polls are left-outer-joined with the finishes of their task in (poll, poll
    + lease]; a poll without any comes out once the watermark has passed its
    deadline, and state older than that is dropped.  Time slices of one lease
    are part of the join key (a finish is given to its own slice and the one
    before), so the polls of a hot task are spread over partitions.

    ``delay`` (required) is how late an event may arrive: Spark drops events
    older than the latest event time seen minus ``delay`` once a micro-batch
    has moved the watermark, and an expired poll is emitted that much later.
    Choose it no smaller than the disorder of the source."""
    events = task_events.select("task", "kind", "ts_ms", F.timestamp_millis("ts_ms").alias("at")).withWatermark("at", delay)
    # Kinds are told apart above the watermark (the condition reads the event
    # time), so every event moves it, also when a task never finishes.
    kind = F.when(F.col("at").isNotNull(), F.col("kind"))
    slice_ = F.floor(F.col("ts_ms") / F.lit(lease_ms))
    polls = events.where(kind == "poll").select("task", F.col("ts_ms").alias("poll_ms"), F.col("at").alias("poll_at"), slice_.alias("slice"))
    ends = events.where(kind == "finish").select(
        F.col("task").alias("end_task"), F.col("at").alias("end_at"), F.explode(F.array(slice_, slice_ - 1)).alias("end_slice")
    )
    met = (
        F.col("task").eqNullSafe(F.col("end_task")) & (F.col("slice") == F.col("end_slice")) & (F.col("end_at") > F.col("poll_at"))
        & (F.col("end_at") <= F.col("poll_at") + F.expr(f"INTERVAL '{lease_ms / 1000:.3f}' SECOND"))
    )
    missed = polls.join(ends, met, "left_outer").where(F.col("end_at").isNull())
    return missed.select("task", "poll_ms", (F.col("poll_ms") + F.lit(lease_ms)).cast("long").alias("recover_ms"))


# --- A9: request metrics by event-time windows -------------------------------------------


def metrics_stream(log: DataFrame, event_time: str, took_ms: str, delay: str, bucket: str = "1 hour") -> DataFrame:
    """A9 running: per event-time window the request count and the timer's
    total and maximum.  In update mode a window comes out again whenever it
    changes; rows older than the watermark are dropped, and so is the state of
    windows behind it."""
    log = log.withWatermark(event_time, delay)
    out = log.groupBy(F.window(event_time, bucket).alias("w")).agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum(took_ms).alias("total_ms"), F.max(took_ms).alias("max_ms")
    )
    return out.select(F.col("w.start").alias("start"), "n_requests", "total_ms", "max_ms")


def run_updates(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Run an update-mode stream into a table of updates, one folder for each
    batch: a batch that is run again replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    q = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def latest_updates(spark: SparkSession, sink: str, key: str) -> DataFrame:
    """The last state of each key in a table of updates."""
    rows = spark.read.parquet(sink)
    cols = [c for c in rows.columns if c not in (key, "batch")]
    last = F.max_by(F.struct(*cols), F.col("batch")).alias("_l")
    return rows.groupBy(key).agg(last).select(key, *[F.col(f"_l.{c}").alias(c) for c in cols])


# --- ST5: politeness with a table of last grants ------------------------------------------


def politeness_batch(spark: SparkSession, base: str, delay_ms: int = DEFAULT_POLITENESS_DELAY_MS):
    """ST5: a ``foreachBatch`` function that schedules ``requests(id, host,
    arrival_ms)`` across micro-batches with the chunked scan of W4, so a host
    with a third of a batch's rows is spread over tasks.

    ``base/grants/batch=N`` holds the batch's rows with ``grant_ms``;
    ``base/last/batch=N`` the last grant of its hosts, which later batches
    start from.  A request older than its host's last grant is served after it
    (processing order).  Requests without host are not delayed: they pass with
    their arrival as grant.  A batch that is run again reads only earlier
    batches and replaces its own folders."""
    root = base.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = stored(batch.select("id", "host", F.col("arrival_ms").cast("long").alias("arrival_ms")), "requests")
        kind = rows.schema["host"].dataType.simpleString()
        hosts = rows.select("host").where(F.col("host").isNotNull()).distinct()
        before = _read_if_there(spark, f"{root}/last", f"host {kind}, last_ms long, batch long").where(F.col("batch") < batch_id)
        last = before.join(hosts, "host", "left_semi").groupBy("host").agg(F.max("last_ms").alias("last_ms"))
        out = politeness.schedule(rows, delay_ms=delay_ms, last=last).drop("wait_ms")
        out.write.mode("overwrite").parquet(f"{root}/grants/batch={batch_id}")
        done = spark.read.schema(out.schema).parquet(f"{root}/grants/batch={batch_id}").where(F.col("host").isNotNull())
        done.groupBy("host").agg(F.max("grant_ms").alias("last_ms")).write.mode("overwrite").parquet(f"{root}/last/batch={batch_id}")

    return run


def read_grants(spark: SparkSession, base: str) -> DataFrame:
    """The scheduled requests of all batches."""
    return spark.read.parquet(f"{base.rstrip('/')}/grants").drop("batch")


# --- running helpers ----------------------------------------------------------------------

def run_available(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Process everything available now into ``sink`` and stop."""
    q = stream.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def replaced_tables(base: str, **options):
    """A ``foreachBatch`` function that writes each micro-batch as a table of
    its own; one that is run again replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**options).parquet(f"{base}-{batch_id}")

    return write


def run_foreach_batch(stream: DataFrame, fn, checkpoint: str) -> None:
    q = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
