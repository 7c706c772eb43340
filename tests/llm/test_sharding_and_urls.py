"""Jump consistent hashing against the published loop, and URL rules."""

import re
import zlib

from pyspark.sql import functions as F

from searchlake.llm import sharding, url_filter
from searchlake.llm.queries import SHARDS, URL_RULES


def jump(key: int, n: int) -> int:
    key &= 2**64 - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_published_loop(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(7, 5000, 13), *(i * 2654435761 for i in range(500))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 41, 1000):
        got = {r["k"]: r["s"] for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_one_shard_more_takes_rows_only_into_itself(spark):
    rows = sharding.assign(spark.range(20000), "id", SHARDS).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {SHARDS}
    assert 300 < len(moved) < 700


def test_documents_get_sizes_checksums_and_gapless_slots(odd_docs):
    rows = sharding.shard_documents(odd_docs, SHARDS).collect()
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in odd_docs.collect()]
    want = sorted(((i or -1), len(t) + 16, zlib.crc32(t), jump(i or 0, SHARDS)) for i, t in texts)
    assert sorted(((r["doc_id"] or -1), r["size"], r["text_crc32"], r["shard"]) for r in rows) == want
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_slots_stay_gapless_for_repeated_keys_and_text_keys(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("n"))
    out = sharding.number(sharding.assign(df, "k", 5), ["k", "n"], "k", groups=7)
    for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect():
        assert r["n"] == r["m"] + 1 == r["d"]


def test_empty_table(no_docs):
    assert sharding.shard_documents(no_docs, SHARDS).count() == 0


def verdict(url, rules, default="allow"):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, default)


URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/1x", "http://example.org", "http://b.com/fr/", "http://b.com/de/?x=/fr/",
    "ftp://notorg/en", "http://x.org?a://b/c", "no scheme", "", None, "http:///only/path", "http://www.example.org/EN/1",
    "http://com/de/1#f", "a://b.COM/fr/://c.org/", "http://é.org/ü", "http://example.org/en/1", "http://example.org/en/1",
]


def test_rules_by_array_and_by_join(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit("clash")).withColumn("id", F.lit(0))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    want = {i: verdict(u, URL_RULES) for i, u in enumerate(URLS)}
    for limit in (url_filter.BROADCAST_BYTES, 0):
        got = url_filter.judge(pages, rules, broadcast_bytes=limit).collect()
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert url_filter.judge(pages, rules.limit(0), default="block").select("verdict").distinct().collect()[0][0] == "block"
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_a_digest_collision_does_not_decide(monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh3_64_intdigest", lambda _: 7)
    array = url_filter.DigestArray({b"org/": True, b"com/": False})
    assert [array.rules[i] if i >= 0 else None for i in array.find([b"com/", b"net/", b"org/"])] == [b"com/", None, b"org/"]
