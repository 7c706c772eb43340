"""URL columns: id, host, robots path, domain filter, href resolution and
normalisation -- all built from regex and string functions, no UDF.

URLs are split with one pattern, ``scheme://authority path ?query #fragment``.
A URL is *valid* when every part has only the characters that a URI allows
there (letters and signs beyond ASCII are allowed, spaces and controls are
not) and every ``%`` starts a two-digit escape.  A host is a name of letter,
digit and hyphen labels whose last label starts with a letter, an IPv4
address or a bracketed IPv6 address; other authorities have no host.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchlake.functions.html import hrefs_of, let, split_page

_BEYOND = r"\x{A1}-\x{167F}\x{1681}-\x{1FFF}\x{200B}-\x{2027}\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}"
_PCHAR = r"a-zA-Z0-9_\-!.~'()*,;:$&+=@%" + _BEYOND
URL_PARTS = (
    r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://([" + _PCHAR + r"\[\]]*)((?:/[" + _PCHAR + r"/]*)?)"
    r"(\?[" + _PCHAR + r"/?\[\]]*)?(#[" + _PCHAR + r"/?\[\]]*)?$"
)
ESCAPE = r"%[0-9A-Fa-f]{2}"
ESCAPES = r"(?:%[0-9A-Fa-f]{2})+|[^%]+"
# What a normalised URL may hold as it is: the rest is written as escapes.
PLAIN = "A-Za-z0-9_\\-.!~*'():@&=+$,;" + _BEYOND
PATH_PIECES = "[" + PLAIN + "/]+|(?s:.)"
QUERY_PIECES = "[" + PLAIN + r"/?\[\]" + "]+|(?s:.)"
USER_PIECES = "[" + PLAIN.replace("@", "") + "]+|(?s:.)"
HOST_IN_AUTHORITY = r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)(?::[0-9]*)?$"
HOST_NAME = (
    r"^(?:(?:[a-zA-Z0-9](?:[a-zA-Z0-9\-]*[a-zA-Z0-9])?\.)*[a-zA-Z](?:[a-zA-Z0-9\-]*[a-zA-Z0-9])?\.?"
    r"|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|\[[0-9a-fA-F:.]+(?:%[a-zA-Z0-9_]+)?\])$"
)
SCHEME_PREFIX = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
PATH_OF_REFERENCE = r"^[^?#]*"
REST_OF_REFERENCE = r"^[^?#]*(.*)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, URL_PARTS, i)


def is_valid(url) -> Column:
    u = _c(url)
    return u.rlike(URL_PARTS) & ~F.regexp_replace(u, ESCAPE, "").contains("%")


def url_id(url) -> Column:
    """Hex of the first 8 bytes of SHA-256 of the UTF-8 URL."""
    return F.substring(F.sha2(_c(url), 256), 1, 16)


def host(url) -> Column:
    """Lower-cased host, NULL when the URL is invalid or has no host."""
    u = _c(url)
    h = F.lower(F.regexp_extract(_part(u, 2), HOST_IN_AUTHORITY, 1))
    return F.when(is_valid(u) & h.rlike(HOST_NAME), h)


def robots_path(url) -> Column:
    """Raw path ('/' when empty) plus '?query' when the query is not blank."""
    u = _c(url)
    path = _part(u, 3)
    query = F.substring(_part(u, 4), 2, 1 << 30)
    p = F.when(path == "", F.lit("/")).otherwise(path)
    return F.when(is_valid(u), F.when(F.trim(query) != "", F.concat(p, F.lit("?"), query)).otherwise(p))


def domain_allowed(url, domain: str | None) -> Column:
    """P5: blank setting keeps every URL; otherwise host == domain or host
    ends with '.' + domain (case-insensitive); URLs without host are dropped."""
    if domain is None or not domain.strip():
        return F.lit(True)
    d = domain.strip().lower()
    h = host(url)
    return F.coalesce((h == F.lit(d)) | h.endswith("." + d), F.lit(False))


def unescape(text: Column) -> Column:
    """Escapes decoded, each run of them as UTF-8 bytes; bytes that are no
    UTF-8 become the replacement character."""

    def piece(p: Column) -> Column:
        raw = F.unhex(F.replace(p, F.lit("%"), F.lit(""))).cast("string")
        return F.when(p.startswith("%"), F.make_valid_utf8(raw)).otherwise(p)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(ESCAPES), F.lit(0)), piece), "")


def escape(text: Column, pieces: str) -> Column:
    """Characters that ``pieces`` doesn't take as they are, as the escapes of
    their UTF-8 bytes."""
    kept = "^" + pieces.split("|(?s")[0] + r"\z"

    def piece(p: Column) -> Column:
        return F.when(p.rlike(kept), p).otherwise(F.regexp_replace(F.hex(F.encode(p, "UTF-8")), "(..)", "%$1"))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(pieces), F.lit(0)), piece), "")


def _again(text: Column, pieces: str) -> Column:
    """Decoded and escaped again; most texts hold no escape."""
    return F.when(text.contains("%"), escape(unescape(text), pieces)).otherwise(text)


def normalize(url) -> Column:
    """T5: path, query and user info decoded and escaped again (so ``%7E``
    becomes ``~``, ``%2F`` a slash and ``%25`` stays), the fragment dropped,
    an empty path ``/``, one trailing ``/`` stripped from the decoded path
    when it is longer than 1, an empty port dropped; scheme and host kept.
    Invalid input is returned unchanged."""

    def whole(part: Column) -> Column:
        bare = F.when(part["path"].contains("%"), unescape(part["path"])).otherwise(part["path"])
        bare = F.when(bare == "", F.lit("/")).otherwise(F.regexp_replace(bare, r"(?s)(.)/\z", "$1"))
        path = F.when(part["path"].contains("%"), escape(bare, PATH_PIECES)).otherwise(bare)
        user = F.regexp_extract(part["authority"], "^([^@]*)@", 1)
        host = F.regexp_replace(F.regexp_replace(part["authority"], "^[^@]*@", ""), ":$", "")
        at = F.when(part["authority"].contains("@"), F.concat(_again(user, USER_PIECES), F.lit("@"))).otherwise(F.lit(""))
        query = F.when(part["query"] != "", F.concat(F.lit("?"), _again(F.substring(part["query"], 2, 1 << 30), QUERY_PIECES)))
        return F.concat(part["scheme"], F.lit("://"), at, host, path, F.coalesce(query, F.lit("")))

    return let(_c(url), lambda u: F.when(is_valid(u), let(_split_url(u), whole)).otherwise(u))


def _remove_dot_segments(path: Column) -> Column:
    """Fold ``.`` and ``..`` of an absolute path, as a stack over its
    segments; ``..`` above the root goes, and a path that ends in a dot
    segment ends in ``/``."""

    def fold(stack: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", stack)
            .when(segment == "..", F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0))))
            .otherwise(F.concat(stack, F.array(segment)))
        )

    def folded(p: Column) -> Column:
        # A last dot segment leaves an empty one behind, for the final "/".
        segments = F.split(F.regexp_replace(p, r"/(\.\.?)$", "/$1/"), "/")
        stack = F.aggregate(F.slice(segments, 2, 1 << 20), F.array().cast("array<string>"), fold)
        return F.when(p.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(stack, "/"))).otherwise(p)

    return let(path, folded)


def _split_url(url: Column) -> Column:
    names = ("scheme", "authority", "path", "query", "fragment")
    return F.struct(*[_part(url, i).alias(n) for i, n in enumerate(names, 1)], is_valid(url).alias("valid"))


def _fold(url: Column) -> Column:
    """An absolute URL with the dot segments of its path folded."""

    def whole(u: Column) -> Column:
        p = _remove_dot_segments(_part(u, 3))
        return F.when(u.rlike(URL_PARTS), F.concat(_part(u, 1), F.lit("://"), _part(u, 2), p, _part(u, 4), _part(u, 5))).otherwise(u)

    return let(url, whole)


def resolve(base, href) -> Column:
    """Absolute URL of ``href`` relative to the page URL ``base``.

    Handles absolute, scheme-relative (``//h/p``), root-relative (``/p``),
    query-only, fragment-only and path-relative references, folding ``.``
    and ``..`` in paths (never in queries or fragments).  NULL when the base
    is invalid and the reference is not absolute.
    """
    return let(_split_url(_c(base)), lambda b: let(F.trim(_c(href)), lambda h: _resolve(b, h)))


def _resolve(b: Column, h: Column) -> Column:
    """``resolve`` of a trimmed reference against a split base."""
    origin = F.concat(b["scheme"], F.lit("://"), b["authority"])
    path = F.regexp_extract(h, PATH_OF_REFERENCE, 0)
    rest = F.regexp_extract(h, REST_OF_REFERENCE, 1)
    directory = F.when(b["path"] == "", F.lit("/")).otherwise(F.regexp_replace(b["path"], r"[^/]*$", ""))
    return (
        F.when(h.rlike(SCHEME_PREFIX), _fold(h))
        .when(~b["valid"], F.lit(None).cast("string"))
        .when(h.startswith("//"), _fold(F.concat(b["scheme"], F.lit(":"), h)))
        .when(h.startswith("/"), F.concat(origin, _remove_dot_segments(path), rest))
        .when(h.startswith("?"), F.concat(origin, b["path"], h))
        .when(h.startswith("#"), F.concat(origin, b["path"], b["query"], h))
        .when(h == "", F.concat(origin, b["path"], b["query"]))
        .otherwise(F.concat(origin, _remove_dot_segments(F.concat(directory, path)), rest))
    )


def extract_links(base, html) -> Column:
    """T4: ``array<string>`` of every ``<a href>`` (document order, duplicates
    kept) resolved against the page URL or the page's first ``<base href>``,
    kept when http(s), normalised.  Tags in scripts, comments and other raw
    text are not scanned."""
    return let(split_page(html), lambda parts: page_links(base, parts))


def page_links(base, parts: Column) -> Column:
    """``extract_links`` of a page that ``html.split_page`` has cut."""
    own = F.get(F.filter(hrefs_of(parts, "base"), lambda h: h != ""), 0)
    against = F.when(own.isNotNull(), F.coalesce(resolve(base, own), _c(base))).otherwise(_c(base))
    absolute = let(let(against, _split_url), lambda b: F.transform(hrefs_of(parts, "a"), lambda h: _resolve(b, h)))
    kept = F.filter(absolute, lambda x: x.startswith("http://") | x.startswith("https://"))
    return F.transform(kept, normalize)
