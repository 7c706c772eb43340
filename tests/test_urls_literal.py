"""Literal cases of link extraction, resolution, validity and hosts, written
from the rules and not from the patterns; the SQL twins must agree."""

import duckdb
import pytest

from searchlake.functions import urls
from searchlake.plans import oracle

LINKS = [
    ("https://h.com/a/b/c/d/e/f/g/h/x", '<a href="../../../../z">', "https://h.com/a/b/c/d/z"),
    ("https://h.com/a/b/c/d/e/f/g/h/i/j/k/x", '<a href="' + "../" * 10 + 'z">', "https://h.com/a/z"),
    ("https://h.com/d/", '<a href="/s?a=1&amp;b=2">', "https://h.com/s?a=1&b=2"),
    ("https://h.com/", "<a href=/unq>x", "https://h.com/unq"),
    ("https://h.com/", """<a href="/it's/ok">""", "https://h.com/it's/ok"),
    ("https://h.com/", '<a data-href="/no" href="/yes">', "https://h.com/yes"),
    ("https://h.com/", """<base href="https://b.org/q/"><a title="x href=no" class=y href='r'>""", "https://b.org/q/r"),
    ("https://h.com/p/q", '<a href="page?next=/a/../b">', "https://h.com/p/page?next=/a/../b"),
    ("https://h.com/", '<a href="https://x.org/a/./b/../c#f">', "https://x.org/a/c"),
    ("https://h.com/", '<a href="https://x.org/a|b#f">', "https://x.org/a|b#f"),
    ("https://h.com/", '<a href="../..">', "https://h.com/"),
    ("https://h.com/a/b/c", '<a href="..">', "https://h.com/a"),
    ("https://h.com/a/b/c", '<a href="./">', "https://h.com/a/b"),
    ("https://h.com/a?q=1", '<a href="#x">', "https://h.com/a?q=1"),
    ("https://h.com/a?q=1", '<a href="">', "https://h.com/a?q=1"),
    ("https://h.com/a", '<a href="//o.org/../z/">', "https://o.org/z"),
    ("https://h.com/a", '<a href="mailto:x@y">', None),
    ("https://h.com/a", '<A\nHREF = "/up" >', "https://h.com/up"),
    ("https://h.com/a", '<abbr href="/no"><a name="x">', None),
    ("https://h.com/é", '<a href="ü?ä=1">', "https://h.com/ü?ä=1"),
]

HOSTS = [
    ("https://h.com/a|b", None), ("https://a_b.com/x", None), ("https://1.2.3.4:80/x", "1.2.3.4"), ("http://u:p@Ex.COM:8080", "ex.com"),
    ("http://[::1]/", "[::1]"), ("https://h.com/%zz", None), ("https://h.com/%41", "h.com"), ("http://", None),
    ("https://h.com/{x}", None), ("http://h.com/a b", None), ("http://xn--a.b-c.de.", "xn--a.b-c.de."), (None, None),
]


#: A normalised URL holds its path and query decoded and escaped again.
NORMAL = [
    ("https://h.com/a%2Fb", "https://h.com/a/b"), ("https://h.com/%7Euser/", "https://h.com/~user"),
    ("https://h.com/a%20b?q=%26x%3D1", "https://h.com/a%20b?q=&x=1"), ("https://h.com/100%25", "https://h.com/100%25"),
    ("https://h.com/a%2F", "https://h.com/a"), ("https://h.com/%2f", "https://h.com/"), ("https://h.com//", "https://h.com/"),
    ("https://h.com/%C3%A9%c3%a9", "https://h.com/éé"), ("https://h.com/é?ü#x", "https://h.com/é?ü"),
    ("https://h.com/%FFx%E2%82y%F0%9F%98%80", "https://h.com/\ufffdx\ufffdy\U0001F600"),
    ("https://h.com/%ED%A0%80%C0%AF", "https://h.com/" + "\ufffd" * 5), ("https://h.com/%zz/#f", "https://h.com/%zz/#f"),
    ("https://h.com/a%2", "https://h.com/a%2"), ("https://h.com/%C2%A0x%0A", "https://h.com/%C2%A0x%0A"),
    ("https://h.com/%5B%5D%7C%3F%23", "https://h.com/%5B%5D%7C%3F%23"), ("https://h.com/?%5B%5D%3F%23%20", "https://h.com/?[]?%23%20"),
    ("http://u%40x:%7Ep@h.com:/p", "http://u%40x:~p@h.com/p"), ("http://h.com:80?", "http://h.com:80/?"), ("http://h.com:/", "http://h.com/"),
]


@pytest.fixture(scope="module")
def con():
    return duckdb.connect()


def test_links(spark, con):
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(LINKS)], "i int, url string, html string")
    got = {r["i"]: r["l"] for r in df.select("i", urls.extract_links("url", "html").alias("l")).collect()}
    con.execute("CREATE TABLE p (i INT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, u, h) for i, (u, h, _) in enumerate(LINKS)])
    twin = dict(con.execute(f"SELECT i, {oracle.links_sql('url', 'html')} FROM p").fetchall())
    want = {i: [w] if w else [] for i, (_, _, w) in enumerate(LINKS)}
    assert got == want
    assert twin == want


def test_hosts_and_invalid_urls_stay_as_they_are(spark, con):
    df = spark.createDataFrame([(u,) for u, _ in HOSTS], "u string").select("u", urls.host("u").alias("h"), urls.normalize("u").alias("n"))
    rows = df.collect()
    assert [r["h"] for r in rows] == [w for _, w in HOSTS]
    by = {r["u"]: r["n"] for r in rows}
    assert by["https://h.com/a|b"] == "https://h.com/a|b" and by["https://h.com/%zz"] == "https://h.com/%zz"
    con.execute("CREATE TABLE q (i INT, u VARCHAR)")
    con.executemany("INSERT INTO q VALUES (?, ?)", [(i, u) for i, (u, _) in enumerate(HOSTS)])
    twin = con.execute(f"SELECT {oracle.host_sql('u')} FROM q ORDER BY i").fetchall()
    assert [t[0] for t in twin] == [w for _, w in HOSTS]


def test_normalised_urls_are_escaped_again(spark, con):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(NORMAL)], "i int, u string")
    got = {r["i"]: r["n"] for r in df.select("i", urls.normalize("u").alias("n")).collect()}
    want = {i: n for i, (_, n) in enumerate(NORMAL)}
    assert got == want
    con.execute("CREATE OR REPLACE TABLE nu (i INT, u VARCHAR)")
    con.executemany("INSERT INTO nu VALUES (?, ?)", [(i, u) for i, (u, _) in enumerate(NORMAL)])
    assert dict(con.execute(f"SELECT i, {oracle.norm_sql('u')} FROM nu").fetchall()) == want
    # Normalising twice is normalising once, but for text that looks escaped.
    again = {r["i"]: r["n"] for r in spark.createDataFrame(list(got.items()), "i int, u string").select("i", urls.normalize("u").alias("n")).collect()}
    assert again == got
