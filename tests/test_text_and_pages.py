from pyspark.sql import functions as F

from searchlake.functions import urls
from searchlake.functions.text import html_title, html_visible_text, tokens
from searchlake.operators import pages

GUIDE = (
    "<html><head><title>Python Guide</title></head><body>\n"
    "<p>Python concurrency is powerful.</p>\n"
    '<a href="/docs/threading">Threading</a>\n'
    '<a href="https://example.com/other">External</a></body></html>'
)


def test_page_parse_fixture(spark):
    df = spark.createDataFrame([("https://example.com/guide", GUIDE)], "url string, html string")
    row = pages.parse_pages(df).first()
    assert row.title == "Python Guide"
    assert row.links == ["https://example.com/docs/threading", "https://example.com/other"]
    assert sorted(row.toks) == sorted(["python", "concurrency", "is", "powerful", "threading", "external"])


def test_short_tokens_dropped(spark):
    df = spark.createDataFrame([("<html><body>a I am ok</body></html>",)], "html string")
    assert df.select(tokens(html_visible_text("html")).alias("t")).first().t == ["am", "ok"]


def test_accents_separate_and_entities_blank(spark):
    df = spark.createDataFrame([("für Straße &amp; x&copy;yz <b>bo</b>ld",)], "t string")
    assert df.select(tokens(html_visible_text("t")).alias("t")).first().t == ["stra", "yz", "bold"]


def test_title_entities_and_whitespace(spark):
    df = spark.createDataFrame([("<title>\n A &amp; B  &lt;c&gt; </title>",)], "h string")
    assert df.select(html_title("h").alias("t")).first().t == "A & B <c>"


def test_url_id_fixture(spark):
    df = spark.createDataFrame([("https://example.com/page",)], "u string")
    assert df.select(urls.url_id("u").alias("i")).first().i == "3641c5f2274c5471"


def test_normalize_cases(spark):
    cases = {
        "http://H.com": "http://H.com/",
        "https://h/a/": "https://h/a",
        "https://h/a//": "https://h/a/",
        "https://h/a/?q=1#f": "https://h/a?q=1",
        "https://h?q=1": "https://h/?q=1",
        "not a url": "not a url",
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    got = {r.u: r.n for r in df.select("u", urls.normalize("u").alias("n")).collect()}
    assert got == cases


def test_resolve_cases(spark):
    base = "https://ex.com/a/b/c.html?x=1"
    cases = {
        "/p": "https://ex.com/p",
        "p": "https://ex.com/a/b/p",
        "../p": "https://ex.com/a/p",
        "./p": "https://ex.com/a/b/p",
        "?q": "https://ex.com/a/b/c.html?q",
        "#f": "https://ex.com/a/b/c.html?x=1#f",
        "//other.org/z": "https://other.org/z",
        "http://abs.net/y": "http://abs.net/y",
    }
    df = spark.createDataFrame([(base, k) for k in cases], "b string, h string")
    got = {r.h: r.r for r in df.select("h", urls.resolve("b", "h").alias("r")).collect()}
    assert got == cases


def test_host_path_domain(spark):
    df = spark.createDataFrame([("https://M.Ex.com:80/a/b?q=1#f",), ("https://ex.com",), ("bad url",)], "u string")
    rows = df.select(urls.host("u").alias("h"), urls.robots_path("u").alias("p"),
                     urls.domain_allowed("u", "ex.com").alias("d")).collect()
    assert [(r.h, r.p, r.d) for r in rows] == [("m.ex.com", "/a/b?q=1", True), ("ex.com", "/", True), (None, None, False)]


def test_silver_rows_of_one_url_keep_their_own_terms(spark):
    """Pages that share a URL, or have none, count their terms row by row."""
    rows = [("https://h/a", "b a b"), ("https://h/a", "b c"), ("https://h/a", None), (None, "x y x"), (None, "x")]
    df = spark.createDataFrame(rows, "url string, text string").withColumn("title", F.lit("t")).withColumn("links", F.array(F.lit("l")))
    toks = df.withColumn("toks", F.split("text", " ")).withColumn("doc_len", F.size("toks"))
    out = pages.silver_documents(toks, processed_at=F.lit("2024-01-01").cast("timestamp")).collect()
    got = sorted((r["url"] or "", sorted(r["termFrequencies"].items())) for r in out)
    assert got == [("", [("x", 1)]), ("", [("x", 2), ("y", 1)]), ("https://h/a", []), ("https://h/a", [("a", 1), ("b", 2)]), ("https://h/a", [("b", 1), ("c", 1)])]
