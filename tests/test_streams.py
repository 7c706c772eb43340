"""Streams over several micro-batches: replays, late rows and state."""

import datetime as dt
import time

from pyspark.sql import functions as F

from searchlake.operators import frontier
from searchlake.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def staged(spark, tmp_path, batches, schema):
    """A file stream that gives one batch of rows at a time."""
    src = str(tmp_path / "src")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_visited_table_keeps_first_offers_and_survives_replays(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "v")
    batches = [["a", "b", "a", None], ["b", "c"], [f"u{i}" for i in range(300)] + ["a"], [f"u{i}" for i in range(100, 400)]]
    run = jobs.visited_batch(spark, base)
    seen = set()
    for n, urls in enumerate(batches):
        df = spark.createDataFrame([(u,) for u in urls], "url string")
        for _ in range(1 + n % 2):  # every second batch is run again
            run(df, n)
        seen |= set(urls) - {None}
        got = [r["url"] for r in jobs.read_visited(spark, base).collect()]
        assert sorted(got) == sorted(seen)
    brought = spark.read.parquet(f"{base}/visited").where("batch = 3").count()
    assert brought == 100
    # The bitmap's size is fixed: every bit set still gives equal results.
    monkeypatch.setattr(jobs, "VISITED_WORDS", 1)
    small = jobs.visited_batch(spark, str(tmp_path / "w"))
    for n, urls in enumerate(batches[2:]):
        small(spark.createDataFrame([(u,) for u in urls], "url string"), n)
    assert sorted(r["url"] for r in jobs.read_visited(spark, str(tmp_path / "w")).collect()) == sorted(seen - {"b", "c"})
    assert spark.read.parquet(f"{tmp_path}/w/bits").where("batch = 1").count() == 1


def test_metrics_windows_are_updated_and_late_rows_dropped(spark, tmp_path):
    def at(minutes):
        return T0 + dt.timedelta(minutes=minutes)

    batches = [
        [(at(0), 5.0), (at(10), 7.0), (at(65), 1.0)],
        [(at(20), 9.0), (at(200), 2.0)],  # late, but within two hours
        [(at(205), 0.5)],
        # The first window is behind the watermark by now (Spark looks at the
        # one that the batch before had).
        [(at(30), 100.0), (at(210), 3.0), (at(100), 4.0)],
    ]
    stream = staged(spark, tmp_path, batches, "at timestamp, took double")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    jobs.run_updates(jobs.metrics_stream(stream, "at", "took", "2 hours"), out, ck)
    got = {r["start"]: (r["n_requests"], r["total_ms"], r["max_ms"]) for r in jobs.latest_updates(spark, out, "start").collect()}
    assert got == {
        T0: (3, 21.0, 9.0), T0 + dt.timedelta(hours=1): (2, 5.0, 4.0), T0 + dt.timedelta(hours=3): (3, 5.5, 3.0)
    }
    first = spark.read.parquet(f"{out}/batch=0").where(F.col("start") == F.lit(T0)).first()
    assert first["n_requests"] == 2


def test_leases_expire_without_any_finish_and_across_batches(spark, tmp_path):
    """Every event moves the watermark; a hot task has most polls."""
    batches = [
        [("t", "poll", 1000), ("hot", "poll", 1500), (None, "poll", 2000)],
        [("t", "finish", 6000), ("hot", "poll", 7000), ("t", "poll", 8000)],
        [("hot", "finish", 6501), ("x", "other", 100_000)],
        [("hot", "poll", 100_500)],
    ]
    stream = staged(spark, tmp_path, batches, "task string, kind string, ts_ms long")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    jobs.run_available(jobs.lease_stream(stream, 5000, "200 seconds"), out, ck)
    assert spark.read.schema("task string, poll_ms long, recover_ms long").parquet(out).count() == 0  # all may still finish
    out, ck = str(tmp_path / "out2"), str(tmp_path / "ck2")
    jobs.run_available(jobs.lease_stream(stream, 5000, "2 seconds"), out, ck)
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=repr)
    # t's finish comes exactly at its deadline; hot's comes 1 ms late.
    assert got == sorted([("hot", 1500, 6500), (None, 2000, 7000), ("hot", 7000, 12000), ("t", 8000, 13000)], key=repr)


def test_frontier_timeline(spark):
    log = [
        ("a", "offer", 100), ("b", "offer", 200), ("a", "offer", 1100), ("a", "poll", 1200), ("b", "poll", 2100), ("a", "finish", 2200),
        ("b", "finish", 3999), ("c", "offer", 5000), (None, "offer", None),
    ]
    out = frontier.frontier_timeline(spark.createDataFrame(log, "u string, k string, t long"), "u", "k", "t", 1000)
    assert sorted(map(tuple, out.collect())) == [
        (0, 2, 2, 0, False), (1, 1, 2, 1, False), (2, 0, 2, 1, False), (3, 0, 2, 0, True), (5, 1, 3, 0, False),
    ]
