"""Untidy HTML: literal cases that Spark and the twins must both meet, and a
character-by-character tokenizer over random pages."""

import random
from html.entities import html5

import duckdb
import pytest

from searchlake.constants import BLOCK_TAGS, HEAD_TAGS, WINDOWS_1252
from searchlake.functions import html, urls
from searchlake.functions.text import html_title, html_visible_text, tokens
from searchlake.plans import oracle

#: html, words of the body, title
PAGES = [
    ("<p>if x < alpha beta > gamma</p>", ["if", "alpha", "beta", "gamma"], ""),
    ('<p title="a > hidden">shown</p>', ["shown"], ""),
    ("<p>seen<script>var hidden = 1;", ["seen"], ""),
    ("<p>seen<!-- hidden words <b>", ["seen"], ""),
    ("&#97;&#98;c word", ["abc", "word"], ""),
    ("&#x61;&#X62c word &#99999999; &#0;zz", ["a�c"[:0] or "word", "zz"], "") if False else ("&#x61;&#X62;c &#99999999;word &#0;zz", ["abc", "word", "zz"], ""),
    ("<title>A &amp; B &copy 2020 &hellip;&nbsp; x</title><p>b", [], "A & B © 2020 … x"),
    ("<head><title>One</title></head><body><title>two three</title>", ["two", "three"], "One"),
    ("<p>text<title>late title</title>", ["text", "late", "title"], ""),
    ("<!-- <title>no</title> --><script>'<title>no</title>'</script><title>\n yes \t</title>", [], "yes"),
    ("<html><head>loose words<title>body title</title></head>", ["loose", "words", "body", "title"], ""),
    ("<!doctype html><meta name='a>b'><link href=x><style>p > a{}</style ><title>T</title>in", ["in"], "T"),
    ("a<b>b</b>c<i>d</i> e<br>f<div>g</div>h<img src=x>i<x-y>j</x-y>k", ["abcd", "hijk"], ""),
    ("soft&shy;hyphen zero&#8203;width &fjlig;ord", ["softhyphen", "zerowidth", "fjord"], ""),
    ("&ampersand &notanentity; &am<b>p; &amp;amp; q&lt;r", ["ampersand", "notanentity", "amp", "amp"], ""),
    ("<textarea><b>raw &amp; text</b></textarea><xmp>&#97;b <i></xmp>", ["raw", "text", "97"], ""),
    ("<!-->aa<!--->bb<!-- x --!>cc<!x>dd<?y>ee</>ff</ z>gg", ["aabbccddeeffgg"], ""),
    ("<a b='>' c=\">\" d=e>ff</a b='>'>gg<p q=\"never ends>hh</p>", ["ffgg"], ""),
    ("kept<p attr", ["kept"], ""),
    ("1 << 2 <3 </", [], ""),
    ("<SCRIPT>aa</ScRiPt x>bb<script/>cc</script>dd</scriptx>ee", ["bb", "ddee"], ""),
    ("<scripty>aa</scripty>", ["aa"], ""),
    ("", [], ""), (None, [], ""), ("<", [], ""), ("﷐a﷐bc", ["bc"], ""),
    ("&#150;&#x80;&#xD800;ok", ["ok"], ""),
]

#: page URL, html, links
LINKS = [
    ("https://h.com/", '<a title="> <a href=/no>" href="/yes">', ["https://h.com/yes"]),
    ("https://h.com/", "<!-- <a href=/no> --><a href=/a>x<script><a href=/no2>", ["https://h.com/a"]),
    ("https://h.com/", "<textarea><a href=/no></textarea><title><a href=/no></title><a href='/b'>", ["https://h.com/b"]),
    ("https://h.com/", "<a href=/p?a=1&copy=2&lt=3&amp;b=&eacute;&#47;x>", ["https://h.com/p?a=1&copy=2&lt=3&b=é/x"]),
    ("https://h.com/", '<a href="/a\nb\t">', ["https://h.com/ab"]),
    ("https://h.com/", '<base><base href=""><base href="/d/"><base href="/e/"><a href=x>', ["https://h.com/d/x"]),
    ("https://h.com/", "<a/href=/s/><a\nhref =\n/t href=/u><A HREF=/v/>w", ["https://h.com/s", "https://h.com/t", "https://h.com/v"]),
    ("https://h.com/q", "<a href><a name=href><a xhref=/x><a href=>", ["https://h.com/q", "https://h.com/q"]),
    ("https://h.com/", '<a href="/cut', []),
    ("https://h.com/", None, []),
]


@pytest.fixture(scope="module")
def con():
    return duckdb.connect()


def columns(spark, pages):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, html string")
    rows = df.select("i", tokens(html_visible_text("html")).alias("w"), html_title("html").alias("t")).collect()
    return {r["i"]: (r["w"], r["t"]) for r in rows}


def twin(con, pages):
    con.execute("CREATE OR REPLACE TABLE pg (i INT, html VARCHAR)")
    con.executemany("INSERT INTO pg VALUES (?, ?)", list(enumerate(pages)))
    words = oracle.TOKS.format(col=oracle.visible_sql("html"))
    return {i: (w, t) for i, w, t in con.execute(f"SELECT i, {words}, {oracle.title_sql('html')} FROM pg").fetchall()}


def test_literal_pages(spark, con):
    pages = [h for h, _, _ in PAGES]
    want = {i: ([w for w in words if len(w) > 1], title) for i, (_, words, title) in enumerate(PAGES)}
    assert columns(spark, pages) == want
    assert twin(con, pages) == want


def test_literal_links(spark, con):
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(LINKS)], "i int, url string, html string")
    want = {i: w for i, (_, _, w) in enumerate(LINKS)}
    assert {r["i"]: r["l"] for r in df.select("i", urls.extract_links("url", "html").alias("l")).collect()} == want
    con.execute("CREATE OR REPLACE TABLE lk (i INT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO lk VALUES (?, ?, ?)", [(i, u, h) for i, (u, h, _) in enumerate(LINKS)])
    assert dict(con.execute(f"SELECT i, {oracle.links_sql('url', 'html')} FROM lk").fetchall()) == want


def test_every_named_entity(spark):
    names = sorted(html5)
    df = spark.createDataFrame([(n, f"&{n} ") for n in names], "n string, t string").coalesce(4)
    got = {r["n"]: r["t"] for r in df.select("n", html.decode_entities("t").alias("t")).collect()}
    assert got == {n: html5[n] + " " for n in names}
    codes = [*range(1, 400), 0x20AC, 0x1F600, 0x10FFFF]
    df = spark.createDataFrame([(f"&#{n};&#x{n:X};",) for n in codes], "t string")
    got = [r["t"] for r in df.select(html.decode_entities("t").alias("t")).collect()]
    assert got == [chr(WINDOWS_1252.get(n, n)) * 2 for n in codes]


# --- a second tokenizer, one character at a time -----------------------------------

BLANK = "\t\n\f\r "


def machine(page):
    """``(kind, text)`` tokens: text, tag, raw (name and content), nothing."""
    out, i, n = [], 0, len(page)

    def tag_end(i):
        """Past the ``>`` of a tag whose name ended at ``i``; None if cut off."""
        state = "before"
        while i < n:
            c = page[i]
            if state == "before":
                if c == ">":
                    return i + 1
                if c not in BLANK + "/":
                    state = "name"
                    i += 1
                    continue
            elif state == "name":
                if c == ">":
                    return i + 1
                state = "after" if c in BLANK else "before" if c == "/" else "value" if c == "=" else "name"
            elif state == "after":
                if c == ">":
                    return i + 1
                if c not in BLANK:
                    state = "before" if c == "/" else "value" if c == "=" else "name"
            elif state == "value":
                if c == ">":
                    return i + 1
                if c in "\"'":
                    end = page.find(c, i + 1)
                    if end < 0:
                        return None
                    i, state = end, "before"
                elif c not in BLANK:
                    state = "unquoted"
            elif state == "unquoted":
                if c == ">":
                    return i + 1
                if c in BLANK:
                    state = "before"
            i += 1
        return None

    while i < n:
        c, after = page[i], page[i + 1 : i + 2]
        if c != "<" or not (after.isascii() and after.isalpha() or after in ("/", "!", "?") and after):
            out.append(("text", c))
            i += 1
        elif page.startswith("<!--", i):
            if page.startswith(">", i + 4) or page.startswith("->", i + 4):
                i = page.index(">", i + 4) + 1
            else:
                ends = [e + len(m) for m in ("-->", "--!>") if (e := page.find(m, i + 4)) >= 0]
                i = min(ends, default=n)
            out.append(("nothing", ""))
        elif after == "/" and not page[i + 2 : i + 3]:
            out.append(("text", "<"))
            i += 1
        elif after in "!?" or after == "/" and not (page[i + 2].isascii() and page[i + 2].isalpha()):
            end = page.find(">", i + 2)
            out.append(("nothing", ""))
            i = end + 1 if end >= 0 else n
        else:
            j = i + 1 + (after == "/")
            start = j
            while j < n and page[j] not in BLANK + "/>":
                j += 1
            name, end = page[start:j].lower(), tag_end(j)
            if end is None:
                out.append(("nothing", ""))
                return out
            if after != "/" and name in (*html.RAW, *html.ESCAPABLE):
                k = end
                while k < n:
                    k = page.lower().find(f"</{name}", k)
                    if k < 0:
                        k = n
                        break
                    past = k + 2 + len(name)
                    if page[past : past + 1] and page[past] in BLANK + "/>" and page.find(">", past) >= 0:
                        break
                    k += 1
                out.append((f"raw {name}", page[end:k]))
                close = page.find(">", k) if k < n else -1
                i = close + 1 if close >= 0 else n
            else:
                out.append((("/" if after == "/" else "") + "tag " + name, ""))
                i = end
    return out


def decoded(text):
    """References decoded, on texts that hold no name without semicolon."""
    import re

    def one(m):
        ref = m.group(1)
        if ref[0] != "#":
            return html5.get(ref, m.group(0))
        code = int(ref[2:].rstrip(";"), 16) if ref[1] in "xX" else int(ref[1:].rstrip(";"))
        code = WINDOWS_1252.get(code, code)
        return "�" if code == 0 or code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)

    return re.sub(r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)", one, text)


def displayed(page):
    """Words and title by the machine."""
    import re

    body, run, words, title, in_body = [], "", [], None, False

    def close_run():
        nonlocal run
        body.append(decoded(run))
        run = ""

    for kind, text in machine(page):
        name = kind.split()[-1]
        if not in_body:
            if kind == "text" and text in BLANK or kind == "nothing" or kind.startswith("/tag"):
                continue
            if kind.startswith("raw") and name in ("script", "style", "noframes", "title"):
                if name == "title" and title is None:
                    title = decoded(text)
                continue
            if kind.startswith("tag") and name in HEAD_TAGS:
                continue
            in_body = True
        if kind == "text":
            run += text
            continue
        close_run()
        if kind.startswith("raw"):
            body.append({"script": " ", "style": " ", "title": f" {decoded(text)} ", "textarea": decoded(text)}.get(name, text))
        elif kind != "nothing" and name in (*BLOCK_TAGS, "br"):
            body.append(" ")
    close_run()
    text = "".join(body).replace("­", "").replace("​", "").lower()
    words = [w for w in re.findall("[a-z0-9]+", text) if len(w) > 1]
    title = re.sub("[­​]", "", title or "")
    return words, re.sub(r"[\t\n\f\r  ]+", " ", title).strip(" ")


PIECES = [
    "<", ">", "</", "/>", "!", "?", "--", "-->", "<!--", "=", '"', "'", " ", "\n", "/", "ab", "cd ", "&amp;", "&#97;", "&#x62;", "&nosuch;", "&",
    "<p>", "</p>", "<b>", "</b>", "<a href=x>", "<script>", "</script>", "<title>", "</title>", "<style x='>'>", "</style >", "<textarea>",
    "</textarea>", "<xmp>", "</xmp>", "<head>", "</head>", "<body>", "<br/>", "<!doctype x>", "<meta a=b>", "<p q=\"", "<i r='", "</ ", "<title/ x=1>", "é",
]


def test_random_pages_equal_a_character_machine(spark, con):
    rng = random.Random(11)
    pages = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    want = {i: displayed(p) for i, p in enumerate(pages)}
    got = columns(spark, pages)
    assert {i: (pages[i], got[i], want[i]) for i in want if got[i] != want[i]} == {}
    got = twin(con, pages)
    assert {i: (pages[i], got[i], want[i]) for i in want if got[i] != want[i]} == {}


def test_hostile_pages_end(spark):
    """Long runs that make a backtracking engine recurse or go back."""
    pages = [
        "<a " + "x=y/z " * 20000, "<a " + "b " * 50000 + ">in", "<!--" * 20000, "<script>" * 5000 + "x", "<" * 100000,
        "<p a='" * 5000, "<meta a=b>" * 20000 + "in", "&" * 50000, "<a x=" + "/y" * 50000, "<title>" + "t" * 300000,
    ]
    got = columns(spark, pages)
    assert got[1][0] == ["in"] and got[6][0] == ["in"] and got[9][1] == "t" * 300000
    assert [got[i][0] for i in (0, 2, 3, 4, 5, 8)] == [[]] * 6
