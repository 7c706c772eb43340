"""DuckDB twins of the registered queries (same column names and types).

They are written independently of the Spark code, as plain SQL over the
driver's views, and serve as the correctness gate.
"""

from __future__ import annotations

from searchlake.constants import BLOCK_TAGS, WINDOWS_1252
from searchlake.functions import html, urls

ORACLE: dict[str, str] = {}

TOKS = "list_filter(regexp_extract_all(lower({col}), '[a-z0-9]+'), lambda x: length(x) >= 2)"

DOC_TOKS = f"SELECT doc_id, {TOKS.format(col='text')} AS toks FROM documents"

# Full BM25 pipeline over ``documents`` as CTEs: post(doc_id, term, tf),
# dl(doc_id, doc_len), dfs(term, df), cs(n, avgdl).
BM25_CTES = f"""
d AS ({DOC_TOKS}),
post AS (SELECT doc_id, term, count(*) AS tf
         FROM (SELECT doc_id, unnest(toks) AS term FROM d) GROUP BY doc_id, term),
dl AS (SELECT doc_id, CAST(len(toks) AS DOUBLE) AS doc_len FROM d WHERE len(toks) > 0),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
cs AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(doc_len) AS DOUBLE) / count(*) AS avgdl FROM dl)
"""


def _bm25_scored(qterms_sql: str, k1: float, b: float) -> str:
    return f"""
q AS ({qterms_sql}),
scored AS (
  SELECT q.qid, p.doc_id,
         round(sum(ln(1 + (cs.n - dfs.df + 0.5) / (dfs.df + 0.5))
                   * (p.tf * ({k1} + 1.0))
                   / (p.tf + {k1} * (1 - {b} + {b} * dl.doc_len / cs.avgdl))), 6) AS score,
         CAST(count(*) AS INTEGER) AS matched
  FROM post p JOIN q ON p.term = q.term JOIN dfs ON dfs.term = p.term
       JOIN dl ON dl.doc_id = p.doc_id CROSS JOIN cs
  GROUP BY q.qid, p.doc_id)
"""


ORACLE["tokenize_docs"] = f"""
WITH d AS ({DOC_TOKS})
SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token FROM d
"""

ORACLE["term_freq"] = f"""
WITH d AS ({DOC_TOKS})
SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
FROM (SELECT doc_id, unnest(toks) AS term FROM d) GROUP BY doc_id, term
"""

ORACLE["doc_length"] = f"""
WITH d AS ({DOC_TOKS})
SELECT doc_id, CAST(len(toks) AS INTEGER) AS doc_len FROM d WHERE len(toks) > 0
"""

ORACLE["doc_freq"] = f"""
WITH d AS ({DOC_TOKS})
SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(toks) AS term FROM d) GROUP BY term
"""

ORACLE["corpus_stats"] = f"""
WITH d AS ({DOC_TOKS}), nz AS (SELECT * FROM d WHERE len(toks) > 0)
SELECT (SELECT count(*) FROM nz) AS n_docs,
       (SELECT count(DISTINCT t) FROM (SELECT unnest(toks) AS t FROM nz)) AS n_terms,
       (SELECT CAST(sum(len(toks)) AS BIGINT) FROM nz) AS total_len,
       round((SELECT CAST(sum(len(toks)) AS DOUBLE) / count(*) FROM nz), 6) AS avgdl
"""

ORACLE["posting_list"] = f"""
WITH d AS ({DOC_TOKS})
SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf
FROM (SELECT doc_id, unnest(toks) AS term FROM d) WHERE term = 'the' GROUP BY term, doc_id
"""

ORACLE["term_lookup"] = f"""
WITH d AS ({DOC_TOKS}),
dfs AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(toks) AS term FROM d) GROUP BY term),
q AS (SELECT DISTINCT unnest({TOKS.format(col='text')}) AS term FROM benchmark)
SELECT q.term, CAST(coalesce(dfs.df, 0) AS BIGINT) AS df FROM q LEFT JOIN dfs ON q.term = dfs.term
"""

_SEARCH_QUERY = "the distributed web crawler and search engine of this"

ORACLE["bm25_search"] = f"""
WITH {BM25_CTES},
{_bm25_scored(f"SELECT DISTINCT 0 AS qid, unnest({TOKS.format(col=repr(_SEARCH_QUERY))}) AS term", 1.2, 0.75)}
SELECT doc_id, score, matched,
       CAST(row_number() OVER (ORDER BY score DESC, matched DESC, doc_id) AS INTEGER) AS rank
FROM scored ORDER BY rank LIMIT 10
"""


def _batch(k1: float, b: float) -> str:
    return f"""
WITH {BM25_CTES},
{_bm25_scored(f"SELECT DISTINCT item_id AS qid, unnest({TOKS.format(col='text')}) AS term FROM benchmark", k1, b)},
ranked AS (SELECT qid AS item_id, doc_id, score, matched,
       CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, matched DESC, doc_id) AS INTEGER) AS rank
       FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""


ORACLE["bm25_batch_topk"] = _batch(1.2, 0.75)
ORACLE["bm25_params"] = _batch(2.0, 0.3)


# --- page ETL twins -----------------------------------------------------------
# SQL text builders.  They share the patterns of ``functions.urls`` (URL
# syntax is a fixed rule); literal cases in the tests check the patterns.


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def part(u: str, i: int) -> str:
    return f"regexp_extract({u}, {q(urls.URL_PARTS)}, {i})"


def valid(u: str) -> str:
    return f"(regexp_matches({u}, {q(urls.URL_PARTS)}) AND NOT contains(regexp_replace({u}, {q(urls.ESCAPE)}, '', 'g'), '%'))"


def _let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


#: UTF-8 in pairs of hexadecimal digits: whole characters first, then what may
#: be the start of one (a single replacement), then any other byte.
_UTF8 = "[0-7].|C[2-9A-F][89AB].|D.[89AB].|E0[AB].[89AB].|E[1-9ABCEF][89AB].[89AB].|ED[89].[89AB].|F0[9AB].[89AB].[89AB].|F[123][89AB].[89AB].[89AB].|F48.[89AB].[89AB]."
_CUT_UTF8 = "E0[AB].|E[1-9ABCEF][89AB].|ED[89].|F0[9AB].(?:[89AB].)?|F[123][89AB].(?:[89AB].)?|F48.(?:[89AB].)?|.."


def unescape_sql(x: str) -> str:
    char = f"CASE WHEN regexp_full_match(h, '{_UTF8}') THEN decode(unhex(h)) ELSE chr(65533) END"
    run = f"array_to_string(list_transform(regexp_extract_all(upper(replace(e, '%', '')), '{_UTF8}|{_CUT_UTF8}'), lambda h: {char}), '')"
    return f"""array_to_string(list_transform(regexp_extract_all({x}, {q(urls.ESCAPES)}), lambda e:
        CASE WHEN starts_with(e, '%') THEN {run} ELSE e END), '')"""


def escape_sql(x: str, pieces: str) -> str:
    kept = q("^" + pieces.split("|(?s")[0] + "$")
    return f"""array_to_string(list_transform(regexp_extract_all({x}, {q(pieces)}), lambda g:
        CASE WHEN regexp_matches(g, {kept}) THEN g ELSE regexp_replace(hex(encode(g)), '(..)', '%\\1', 'g') END), '')"""


def norm_sql(u: str) -> str:
    bare = _let(f"(CASE WHEN contains(pt, '%') THEN {unescape_sql('pt')} ELSE pt END)", "w",
                "(CASE WHEN w = '' THEN '/' WHEN length(w) > 1 AND ends_with(w, '/') THEN left(w, length(w) - 1) ELSE w END)")
    path = _let(part(u, 3), "pt", _let(bare, "bp", f"(CASE WHEN contains(pt, '%') THEN {escape_sql('bp', urls.PATH_PIECES)} ELSE bp END)"))
    user = "regexp_extract(au, '^([^@]*)@', 1)"
    host = "regexp_replace(regexp_replace(au, '^[^@]*@', ''), ':$', '')"
    at = f"(CASE WHEN contains(au, '@') THEN {escape_sql(unescape_sql(user), urls.USER_PIECES)} || '@' ELSE '' END)"
    authority = _let(part(u, 2), "au", f"{at} || {host}")
    query = _let(f"substring({part(u, 4)}, 2)", "qy", escape_sql(unescape_sql("qy"), urls.QUERY_PIECES))
    query = f"(CASE WHEN {part(u, 4)} <> '' THEN '?' || {query} ELSE '' END)"
    return f"(CASE WHEN {valid(u)} THEN {part(u, 1)} || '://' || ({authority}) || {path} || {query} ELSE {u} END)"


def dots_sql(p: str) -> str:
    segs = f"string_split({p}, '/')"
    folded = f"""list_reduce(list_concat([[]::VARCHAR[]], list_transform({segs}[2:], lambda s: [s])),
        lambda acc, s: CASE s[1] WHEN '.' THEN acc WHEN '..' THEN acc[:len(acc) - 1] ELSE list_concat(acc, s) END)"""
    last = f"CASE WHEN {segs}[-1] IN ('.', '..') THEN list_concat({folded}, ['']) ELSE {folded} END"
    return f"(CASE WHEN regexp_matches({p}, '/\\.\\.?(/|$)') THEN '/' || array_to_string({last}, '/') ELSE {p} END)"


def fold_sql(u: str) -> str:
    return f"""(CASE WHEN regexp_matches({u}, {q(urls.URL_PARTS)}) THEN {part(u, 1)} || '://' || {part(u, 2)} ||
      {dots_sql(part(u, 3))} || {part(u, 4)} || {part(u, 5)} ELSE {u} END)"""


def resolve_sql(b: str, h: str) -> str:
    origin = f"({part(b, 1)} || '://' || {part(b, 2)})"
    bpath = part(b, 3)
    bdir = f"regexp_replace(CASE WHEN {bpath} = '' THEN '/' ELSE {bpath} END, '[^/]*$', '')"
    hpath, rest = f"regexp_extract({h}, '^[^?#]*')", f"regexp_extract({h}, '^[^?#]*(.*)$', 1)"
    return f"""(CASE WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN {fold_sql(h)}
      WHEN NOT {valid(b)} THEN NULL
      WHEN starts_with({h}, '//') THEN {fold_sql(f"({part(b, 1)} || ':' || {h})")}
      WHEN starts_with({h}, '/') THEN {origin} || {dots_sql(hpath)} || {rest}
      WHEN starts_with({h}, '?') THEN {origin} || {bpath} || {h}
      WHEN starts_with({h}, '#') THEN {origin} || {bpath} || {part(b, 4)} || {h}
      WHEN {h} = '' THEN {origin} || {bpath} || {part(b, 4)}
      ELSE {origin} || {dots_sql(f"({bdir} || {hpath})")} || {rest} END)"""


def host_sql(u: str) -> str:
    h = f"lower(regexp_extract({part(u, 2)}, {q(urls.HOST_IN_AUTHORITY)}, 1))"
    return f"(CASE WHEN {valid(u)} AND regexp_matches({h}, {q(urls.HOST_NAME)}) THEN {h} END)"


def robots_path_sql(u: str) -> str:
    path = f"(CASE WHEN {part(u, 3)} = '' THEN '/' ELSE {part(u, 3)} END)"
    query = f"substring({part(u, 4)}, 2)"
    return f"(CASE WHEN {valid(u)} THEN (CASE WHEN trim({query}) <> '' THEN {path} || '?' || {query} ELSE {path} END) END)"


_P = html.pattern_set(possessive=False)
_JOINT, _SHY, _ZWSP, _NBSP = "chr(64976)", "chr(173)", "chr(8203)", "chr(160)"


def _map(table: dict) -> str:
    keys, values = ([q(x) if isinstance(x, str) else str(x) for x in part] for part in zip(*sorted(table.items())))
    return f"map([{', '.join(keys)}], [{', '.join(values)}])"


_NAMES, _WINDOWS = _map(html.entity_table()), _map(WINDOWS_1252)


def decode_sql(t: str, attribute: bool = False) -> str:
    """References decoded, piece by piece after each '&'."""
    number = """(CASE WHEN length(digits) > 7 THEN 1073741824 WHEN digits = '' THEN 0
        WHEN lower(r[2]) = 'x' THEN ('0x' || digits)::BIGINT ELSE digits::BIGINT END)"""
    point = "(CASE WHEN w = 0 OR w BETWEEN 55296 AND 57343 OR w > 1114111 THEN 65533 ELSE w END)"
    digits = "regexp_extract(r, '^#[xX]?0*([0-9a-fA-F]*)', 1)"
    numeric = _let(digits, "digits", _let(_let(number, "n", f"coalesce({_WINDOWS}[n], n)"), "w", f"chr({point}::INTEGER)"))
    named = f"{_NAMES}[r]"
    if attribute:
        named = f"CASE WHEN ends_with(r, ';') OR NOT starts_with(substr(p, length(r) + 1), '=') THEN {_NAMES}[r] END"
    char = f"CASE WHEN r = '' THEN NULL WHEN starts_with(r, '#') THEN {numeric} ELSE {named} END"
    piece = _let(f"regexp_extract(p, {q(html.REFERENCE)})", "r", f"coalesce(({char}) || substr(p, length(r) + 1), '&' || p)")
    return _let(f"string_split({t}, '&')", "ps", f"ps[1] || array_to_string(list_transform(ps[2:], lambda p: {piece}), '')")


def _head_sql(h: str) -> str:
    return f"regexp_extract(replace(coalesce({h}, ''), {_JOINT}, ' '), {q(_P['head'])})"


def _tokens_sql(text: str) -> str:
    return f"regexp_extract_all({text}, {q(_P['token'])})"


def _is(t: str, tags: str) -> str:
    return f"regexp_matches({t}, '(?i)^</?(?:{tags})[\\t\\n\\f\\r />]') AND NOT starts_with({t}, '</')"


def _content_sql(t: str) -> str:
    end = f"'(?i)</' || regexp_extract({t}, '^<([a-zA-Z]+)', 1) || '(?:>|[\\t\\n\\f\\r /][^>]*>)\\z'"
    return f"regexp_replace(regexp_replace({t}, {q(_P['raw_opening'])}, ''), {end}, '')"


def visible_sql(h: str) -> str:
    content = _content_sql("t")
    raw = f"replace({content}, '&', '&' || {_JOINT})"
    blocks = "|".join(("br", *BLOCK_TAGS))
    piece = f"""CASE WHEN NOT starts_with(t, '<') OR t = '<' THEN t WHEN {_is('t', 'script|style')} THEN ' '
        WHEN {_is('t', 'title')} THEN ' ' || {content} || ' ' WHEN {_is('t', 'textarea')} THEN {content}
        WHEN {_is('t', '|'.join(html.RAW))} THEN {raw}
        WHEN regexp_matches(t, '(?i)^</?(?:{blocks})[\\t\\n\\f\\r />]') THEN ' ' ELSE {_JOINT} END"""
    whole = f"replace(coalesce({h}, ''), {_JOINT}, ' ')"
    body = f"substr({whole}, length({_head_sql(h)}) + 1)"
    joined = f"array_to_string(list_transform({_tokens_sql(body)}, lambda t: {piece}), '')"
    return f"replace(replace(replace({decode_sql(joined)}, {_JOINT}, ''), {_SHY}, ''), {_ZWSP}, '')"


def title_sql(h: str) -> str:
    first = f"list_filter({_tokens_sql(_head_sql(h))}, lambda t: {_is('t', 'title')})[1]"
    text = decode_sql(_let(f"coalesce({first}, '')", "t", _content_sql("t")))
    text = f"replace(replace(replace({text}, {_SHY}, ''), {_ZWSP}, ''), {_NBSP}, ' ')"
    return f"trim(regexp_replace({text}, '[\\t\\n\\f\\r ]+', ' ', 'g'))"


def hrefs_sql(tokens: str, tag: str) -> str:
    """The href values of all start tags of a name, a null where it has none."""
    attributes = f"regexp_extract_all(regexp_replace(t, '^<[^\\t\\n\\f\\r />]+', ''), {q(_P['attribute'])})"
    own = f"list_filter({attributes}, lambda a: regexp_matches(a, {q(html.HREF_ATTRIBUTE)}))[1]"
    value = " || ".join(f"regexp_extract(o, {q(_P['attribute_value'])}, {i})" for i in (1, 2, 3))
    href = _let(own, "o", f"trim(regexp_replace({decode_sql(f'({value})', attribute=True)}, '[\\x00-\\x1F]', '', 'g'))")
    return f"list_transform(list_filter({tokens}, lambda t: regexp_matches(t, {q(html.tag_token(tag, _P))})), lambda t: {href})"


def links_sql(u: str, h: str) -> str:
    """The list of a page's links, as a correlated subquery per step so that
    each expression is written once."""
    head = _head_sql(h)
    body = f"substr(replace(coalesce({h}, ''), {_JOINT}, ' '), length({head}) + 1)"
    return f"""(SELECT list_transform(list_filter(list_transform(hrefs, lambda x: {resolve_sql('against', 'x')}),
          lambda x: starts_with(x, 'http://') OR starts_with(x, 'https://')), lambda x: {norm_sql('x')})
       FROM (SELECT CASE WHEN own IS NOT NULL THEN coalesce({resolve_sql('page', 'own')}, page) ELSE page END AS against, hrefs
             FROM (SELECT page, list_filter({hrefs_sql('toks', 'base')}, lambda x: x <> '')[1] AS own,
                          list_filter({hrefs_sql('toks', 'a')}, lambda x: x IS NOT NULL) AS hrefs
                   FROM (SELECT {u} AS page, list_concat({_tokens_sql(head)}, {_tokens_sql(body)}) AS toks))))"""


ORACLE["page_title"] = f"SELECT page_id, {title_sql('html')} AS title FROM pages"

ORACLE["page_terms"] = f"""
WITH t AS (SELECT page_id, unnest({TOKS.format(col=visible_sql('html'))}) AS term FROM pages)
SELECT page_id, term, CAST(count(*) AS INTEGER) AS tf FROM t GROUP BY page_id, term
"""

ORACLE["page_links"] = f"""
WITH l AS (SELECT page_id, {links_sql('url', 'html')} AS links FROM pages)
SELECT page_id, CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS pos, unnest(links) AS link FROM l
"""

ORACLE["link_edges"] = f"""
WITH l AS (SELECT url AS src, unnest({links_sql('url', 'html')}) AS dst FROM pages)
SELECT src, dst, count(*) AS n_links FROM l GROUP BY src, dst
"""

ORACLE["url_normalize"] = f"SELECT page_id, {norm_sql('url')} AS norm_url FROM pages"
ORACLE["url_id"] = "SELECT page_id, left(sha256(url), 16) AS url_id FROM pages"
ORACLE["url_parts"] = f"SELECT page_id, {host_sql('url')} AS host, {robots_path_sql('url')} AS robots_path FROM pages"
ORACLE["domain_filter"] = f"""
SELECT page_id, url FROM pages
WHERE coalesce({host_sql('url')} = 'example.com' OR ends_with({host_sql('url')}, '.example.com'), false)
"""


# --- robots twins ---------------------------------------------------------------

_TEMPLATES = [
    "",
    "User-agent: *\nDisallow: /{lang}/\nAllow: /{lang}/1\n",
    "User-agent: ConcurrentCrawler\nDisallow: /*?page=\nAllow: /*?page=1$\n\nUser-agent: *\nDisallow: /\n",
    "User-agent: concurrentcrawler/1.0\r\nDisallow: /en/  # no english\r\nUser-agent: *\r\nAllow: /\r\nCrawl-delay: 5\r\n",
    "User-agent: other-bot\nUser-agent: *\nDisallow: /*.pdf$\nDisallow: /fr\nAllow: /fr/2\nSitemap: https://x/s.xml\n",
    "User-agent: *\nDisallow:\n",
]


def _sql_text(s: str) -> str:
    parts = s.split("\n")
    out = []
    for i, seg in enumerate(parts):
        sub = seg.split("\r")
        pieces = " || chr(13) || ".join(q(x) for x in sub)
        out.append(pieces)
    return "(" + " || chr(10) || ".join(out) + ")"


_JT = r"'^[\x00-\x20]+|[\x00-\x20]+$'"

ROBOTS_CTES = f"""
hosts AS (SELECT DISTINCT {host_sql('url')} AS domain FROM pages WHERE {host_sql('url')} IS NOT NULL),
hd AS (SELECT domain, instr('0123456789abcdef', left(sha256(domain), 1)) - 1 AS digit FROM hosts),
robots AS (SELECT domain,
   replace([{', '.join(_sql_text(t) for t in _TEMPLATES)}][digit % 6 + 1], '{{lang}}', ['en','fr','de','es'][digit % 4 + 1]) AS content FROM hd),
raw AS (SELECT domain, unnest(generate_series(1, len(string_split_regex(content, '\\r?\\n')))) AS line_no,
               unnest(string_split_regex(content, '\\r?\\n')) AS raw FROM robots),
l1 AS (SELECT domain, line_no, regexp_replace(split_part(raw, '#', 1), {_JT}, '', 'g') AS line FROM raw),
l2 AS (SELECT domain, line_no,
              lower(regexp_replace(split_part(line, ':', 1), {_JT}, '', 'g')) AS directive,
              regexp_replace(substring(line, instr(line, ':') + 1), {_JT}, '', 'g') AS value
       FROM l1 WHERE instr(line, ':') > 0),
l3 AS (SELECT *, sum(CASE WHEN directive = 'user-agent' THEN 1 ELSE 0 END)
                 OVER (PARTITION BY domain ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS grp
       FROM l2 WHERE directive IN ('user-agent', 'allow', 'disallow')),
g AS (SELECT domain, grp, lower(value) AS agent,
             CASE WHEN lower(value) = '*' THEN 2 WHEN lower(value) = 'concurrentcrawler/1.0' THEN 0
                  WHEN starts_with('concurrentcrawler/1.0', lower(value)) THEN 1 END AS cls
      FROM l3 WHERE directive = 'user-agent'),
chosen AS (SELECT domain, grp FROM (
      SELECT domain, grp, row_number() OVER (PARTITION BY domain ORDER BY cls,
             CASE WHEN cls = 1 THEN -length(agent) ELSE 0 END, CASE WHEN cls = 1 THEN grp ELSE -grp END) AS rn
      FROM g WHERE cls IS NOT NULL) WHERE rn = 1),
rules AS (SELECT l3.domain, l3.value AS pattern, l3.directive = 'allow' AS allow,
      '^' || replace(regexp_replace(CASE WHEN ends_with(l3.value, '$') THEN left(l3.value, length(l3.value) - 1) ELSE l3.value END,
                                    '([\\\\.\\[\\]{{}}()+\\-^?|])', '\\\\\\1', 'g'), '*', '.*')
          || CASE WHEN ends_with(l3.value, '$') THEN '$' ELSE '.*' END AS rx
      FROM l3 JOIN chosen ON l3.domain = chosen.domain AND l3.grp = chosen.grp
      WHERE l3.directive <> 'user-agent')
"""


def _allowed_sql(targets: str, url: str) -> str:
    path = robots_path_sql(url)
    npath = f"(CASE WHEN {path} IS NULL OR trim({path}) = '' THEN '/' WHEN starts_with({path}, '/') THEN {path} ELSE '/' || {path} END)"
    return f"""
t AS (SELECT *, {host_sql(url)} AS _domain, {npath} AS _path FROM {targets}),
m AS (SELECT t._rid, max(struct_pack(n := length(r.pattern), allow := r.allow)) AS best
      FROM t JOIN rules r ON r.domain = t._domain AND regexp_matches(t._path, r.rx) GROUP BY t._rid),
a AS (SELECT t.*, CASE WHEN t._domain IS NULL THEN false ELSE coalesce(m.best.allow, true) END AS allowed
      FROM t LEFT JOIN m ON t._rid = m._rid)
"""


ORACLE["robots_rules"] = f"WITH {ROBOTS_CTES} SELECT domain, pattern, allow FROM rules"

ORACLE["robots_allowed"] = f"""
WITH {ROBOTS_CTES}, tg AS (SELECT page_id AS _rid, page_id, url FROM pages),
{_allowed_sql('tg', 'url')}
SELECT page_id, allowed FROM a
"""

ORACLE["links_allowed"] = f"""
WITH {ROBOTS_CTES},
e0 AS (SELECT url AS src, {links_sql('url', 'html')} AS links FROM pages),
e AS (SELECT src, CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS pos, unnest(links) AS dst FROM e0),
tg AS (SELECT row_number() OVER () AS _rid, * FROM e
       WHERE coalesce({host_sql('dst')} = 'example.com' OR ends_with({host_sql('dst')}, '.example.com'), false)),
{_allowed_sql('tg', 'dst')}
SELECT src, pos, dst FROM a WHERE allowed
"""


# --- frontier twins ---------------------------------------------------------------

_BFS = """
WITH RECURSIVE e AS (
  SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR) AS src, 'p' || CAST(l_partkey AS VARCHAR) AS dst FROM lineitem
  UNION SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR), 's' || CAST(l_suppkey AS VARCHAR) FROM lineitem),
walk(url, depth) AS (SELECT 's1', 0 UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.url WHERE w.depth < 3),
v AS (SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY url)
"""

ORACLE["bfs_depth"] = _BFS + "SELECT url, depth FROM v"
ORACLE["bfs_capped"] = _BFS + "SELECT url, depth FROM v ORDER BY depth, url LIMIT 100"

_NODES = """
li AS (SELECT DISTINCT 'https://h' || l_suppkey % 50 || '.example.com/en/s' || l_suppkey AS s,
              'https://h' || l_partkey % 50 || '.example.' || CASE WHEN l_partkey % 3 = 0 THEN 'org' ELSE 'com' END || '/fr/p' || l_partkey AS p,
              l_partkey % 4 <> 3 AS there FROM lineitem),
e AS (SELECT s AS src, p AS dst FROM li UNION SELECT p, s FROM li),
nodes AS (SELECT DISTINCT dst AS url FROM e),
page AS (SELECT s AS url FROM li UNION SELECT p FROM li WHERE there)
"""

_CRAWL = f"""
WITH RECURSIVE {_NODES},
{ROBOTS_CTES.replace('FROM pages WHERE', 'FROM nodes WHERE')},
tg AS (SELECT url AS _rid, url FROM nodes WHERE coalesce({host_sql('url')} = 'example.com' OR ends_with({host_sql('url')}, '.example.com'), false)),
{_allowed_sql('tg', 'url')},
free AS (SELECT url FROM a WHERE allowed),
seeds AS (SELECT 'https://h' || k || '.example.com/en/s' || k AS url FROM range(1, 6) r(k)),
walk(url, depth, fetched) AS (
  SELECT url, 0, url IN (SELECT url FROM free) AND url IN (SELECT url FROM page) FROM seeds
  UNION
  SELECT e.dst, w.depth + 1, e.dst IN (SELECT url FROM page)
  FROM walk w JOIN e ON e.src = w.url JOIN free ON free.url = e.dst WHERE w.fetched AND w.depth < 3),
v AS (SELECT url, CAST(min(depth) AS INTEGER) AS depth, bool_or(fetched) AS fetched FROM walk GROUP BY url)
"""

ORACLE["crawl_bfs"] = _CRAWL + "SELECT url, depth, fetched FROM v"
ORACLE["frontier_counts"] = _CRAWL + "SELECT depth, count(*) AS n_offered, count(CASE WHEN fetched THEN 1 END) AS n_fetched FROM v GROUP BY depth"

ORACLE["frontier_timeline"] = """
WITH ev AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS u, epoch_us(ts) // 1000 AS t,
                   CASE WHEN event_type IN ('view', 'signup') THEN 'offer' WHEN event_type = 'click' THEN 'poll' ELSE 'finish' END AS k
            FROM events WHERE ts IS NOT NULL),
moves AS (SELECT min(t) AS t, 1 AS v, 0 AS p, 0 AS e FROM ev WHERE k = 'offer' GROUP BY u
          UNION ALL SELECT t, 0, CASE WHEN k = 'poll' THEN 1 ELSE 0 END, CASE WHEN k = 'finish' THEN 1 ELSE 0 END FROM ev WHERE k <> 'offer'),
d AS (SELECT CAST(floor(t / 3600000) AS BIGINT) AS bucket, sum(v) AS v, sum(p) AS p, sum(e) AS e FROM moves GROUP BY 1),
r AS (SELECT bucket, CAST(sum(v) OVER w AS BIGINT) AS v, CAST(sum(p) OVER w AS BIGINT) AS p, CAST(sum(e) OVER w AS BIGINT) AS e
      FROM d WINDOW w AS (ORDER BY bucket ROWS UNBOUNDED PRECEDING))
SELECT bucket, v - p AS queued, v AS visited, p - e AS in_flight, v - p <= 0 AND p - e <= 0 AS idle FROM r
"""

ORACLE["frontier_offer"] = f"""
WITH e0 AS (SELECT {links_sql('url', 'html')} AS links FROM pages),
e AS (SELECT CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS pos, unnest(links) AS dst FROM e0),
best AS (SELECT dst AS url, min(pos) AS depth FROM e GROUP BY dst)
SELECT url, depth FROM best WHERE url NOT IN (SELECT {norm_sql('url')} FROM pages)
"""


# --- politeness and log twins -------------------------------------------------------

ORACLE["politeness_schedule"] = """
WITH r AS (SELECT event_id, user_id, (epoch_us(ts) // 1000) AS a,
                  row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS i
           FROM events WHERE user_id IS NOT NULL),
g AS (SELECT event_id, user_id, a,
             i * 1000 + max(a - i * 1000) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS grant_ms
      FROM r)
SELECT event_id, user_id, CAST(grant_ms - a AS BIGINT) AS wait_ms FROM g
UNION ALL SELECT event_id, user_id, CAST(0 AS BIGINT) FROM events WHERE user_id IS NULL
"""

ORACLE["fetch_attempts"] = """
WITH log AS (
  SELECT 'https://h' || CAST(user_id % 50 AS VARCHAR) || '.example.com/item/' || CAST(floor(event_id / 3) AS BIGINT) AS url,
         CAST(event_id % 3 + 1 AS INTEGER) AS attempt,
         CAST(CASE WHEN event_type IN ('view', 'purchase') THEN 200 WHEN event_type = 'click' THEN 503
                   WHEN event_type = 'signup' THEN 404 END AS INTEGER) AS status,
         CASE WHEN event_type = 'purchase' THEN 'application/json' ELSE 'text/html; charset=UTF-8' END AS ct
  FROM events),
a AS (SELECT *, (status IS NOT NULL AND status <> 429 AND status < 500) OR attempt = 3 AS terminal FROM log WHERE attempt <= 3),
t AS (SELECT url, min(CASE WHEN terminal THEN attempt END) AS ta, max(attempt) AS la FROM a GROUP BY url),
f AS (SELECT t.url, coalesce(t.ta, t.la) AS fa FROM t)
SELECT f.url, CAST(f.fa AS INTEGER) AS attempts, coalesce(a.status, 0) AS final_status,
       coalesce(a.status >= 200 AND a.status < 300 AND (contains(coalesce(a.ct, ''), 'text/html') OR contains(coalesce(a.ct, ''), 'application/xhtml')), false) AS accepted,
       CAST((SELECT coalesce(sum(200 * pow(2, least(x - 1, 10))), 0) FROM range(1, f.fa) r(x)) AS BIGINT) AS backoff_ms
FROM f JOIN a ON a.url = f.url AND a.attempt = f.fa
"""

ORACLE["lease_recovery"] = """
WITH ev AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS task,
                   CASE WHEN event_type = 'view' THEN 'poll' WHEN event_type = 'purchase' THEN 'finish' END AS kind,
                   (epoch_us(ts) // 1000) AS ts_ms, event_id FROM events),
e AS (SELECT * FROM ev WHERE kind IS NOT NULL),
n AS (SELECT task, kind, ts_ms,
             min(CASE WHEN kind = 'finish' THEN ts_ms END) OVER (PARTITION BY task
                 ORDER BY ts_ms, CASE WHEN kind = 'finish' THEN 0 ELSE 1 END, event_id
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS finish_ms
      FROM e)
SELECT task, ts_ms AS poll_ms, CAST(ts_ms + 43200000 AS BIGINT) AS recover_ms, finish_ms IS NOT NULL AS late_finish
FROM n WHERE kind = 'poll' AND (finish_ms IS NULL OR finish_ms > ts_ms + 43200000)
"""

ORACLE["latency_percentiles"] = """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS idx,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events),
p AS (SELECT event_type, n,
             max(CASE WHEN idx = greatest(1, least(n, ceil(0.5 * n))) THEN value END) AS p50,
             max(CASE WHEN idx = greatest(1, least(n, ceil(0.95 * n))) THEN value END) AS p95,
             max(CASE WHEN idx = greatest(1, least(n, ceil(0.99 * n))) THEN value END) AS p99
      FROM r GROUP BY event_type, n),
s AS (SELECT event_type, (max((epoch_us(ts) // 1000)) - min((epoch_us(ts) // 1000))) / 1000.0 AS el FROM events GROUP BY event_type)
SELECT p.event_type, p.n, p50, p95, p99, round(p.n / greatest(CAST(s.el AS DOUBLE), 1e-6), 6) AS qps
FROM p JOIN s USING (event_type)
"""

ORACLE["search_metrics"] = """
SELECT CAST(floor((epoch_us(ts) // 1000) / 3600000) AS BIGINT) AS bucket, count(*) AS n_requests,
       round(sum(value), 6) AS total_ms, max(value) AS max_ms
FROM events GROUP BY 1
"""


# --- Bronze / Silver / Gold twins ------------------------------------------------------

_FETCHED = """
fetched AS (SELECT page_id, url, html,
   [200,200,200,200,200,200,200,200,200,200,301,404,500,503,200,204][instr('0123456789abcdef', left(sha256(url), 1))] AS status,
   ['text/html; charset=utf-8','text/html','application/xhtml+xml','TEXT/HTML','application/json'][(instr('0123456789abcdef', left(sha256(url), 1)) - 1) % 5 + 1] AS ct,
   1704067200000 + page_id * 1000 AS fetched_ms FROM pages)
"""

ORACLE["bronze_accept"] = f"""
WITH {_FETCHED}
SELECT page_id, coalesce(status >= 200 AND status < 300 AND (contains(ct, 'text/html') OR contains(ct, 'application/xhtml')), false) AS accepted
FROM fetched
"""

ORACLE["bronze_latest"] = """
SELECT user_id, ts_ms, event_id, event_type FROM (
  SELECT user_id, (epoch_us(ts) // 1000) AS ts_ms, event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000) DESC, event_id DESC, event_type DESC) AS rn
  FROM events) WHERE rn = 1
"""

ORACLE["bronze_upsert"] = f"""
WITH {_FETCHED},
both AS (SELECT url, html, fetched_ms FROM fetched
         UNION ALL SELECT url, html || '<p>again</p>', fetched_ms + 1000000 FROM fetched WHERE page_id % 3 = 0),
last AS (SELECT *, row_number() OVER (PARTITION BY left(sha256(url), 16) ORDER BY fetched_ms DESC) AS rn FROM both)
SELECT left(sha256(url), 16) AS id, url, fetched_ms, CAST(length(html) AS INTEGER) AS n_html, md5(html) AS html_md5 FROM last WHERE rn = 1
""".replace("both AS", "versions AS").replace("FROM both", "FROM versions")

ORACLE["bronze_files"] = f"""
WITH {_FETCHED}
SELECT left(sha256(url), 16) AS id, url, status AS "statusCode", fetched_ms, CAST(page_id AS VARCHAR) AS n,
       md5(CASE WHEN page_id % 10 = 0 THEN html || '<p>named</p>' ELSE html END) AS html_md5
FROM fetched WHERE page_id % 10 = 0 OR page_id % 9 <> 4
"""
ORACLE["stream_bronze_files"] = ORACLE["bronze_files"]

ORACLE["header_flatten"] = f"""
WITH {_FETCHED}
SELECT page_id, 'content-type' AS name, ct AS value FROM fetched
UNION ALL SELECT page_id, 'set-cookie', ['c1', 'c1, c2', 'c1, c2, c3'][page_id % 3 + 1] FROM fetched
"""

ORACLE["index_replace"] = f"""
WITH v2 AS (
  SELECT doc_id, CASE WHEN lang = 'fr' THEN (CASE WHEN n_chars > 1000 THEN text || ' ' || text ELSE '' END) ELSE text END AS text
  FROM documents),
d AS (SELECT doc_id, {TOKS.format(col='text')} AS toks FROM v2)
SELECT doc_id, CAST(len(any_value(toks)) AS INTEGER) AS doc_len, CAST(len(any_value(toks)) AS INTEGER) AS stat_len, term,
       CAST(count(*) AS INTEGER) AS tf, count(*) OVER (PARTITION BY term) AS df
FROM (SELECT doc_id, toks, unnest(toks) AS term FROM d) GROUP BY doc_id, term
"""

ORACLE["index_export"] = f"""
WITH d AS ({DOC_TOKS}),
post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM d) GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term)
SELECT p.term, CAST(dfs.df AS VARCHAR) AS df, CAST(p.doc_id AS VARCHAR) AS doc, CAST(p.tf AS VARCHAR) AS tf
FROM post p JOIN dfs USING (term)
"""

ORACLE["pipeline_counts"] = f"""
WITH {_FETCHED},
acc AS (SELECT * FROM fetched WHERE coalesce(status >= 200 AND status < 300 AND (contains(ct, 'text/html') OR contains(ct, 'application/xhtml')), false)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY left(sha256(url), 16) ORDER BY fetched_ms DESC, url DESC, html DESC) AS rn FROM fetched) WHERE rn = 1),
kept AS (SELECT * FROM latest WHERE coalesce(status >= 200 AND status < 300 AND (contains(ct, 'text/html') OR contains(ct, 'application/xhtml')), false))
SELECT count(*) AS silver_documents,
       count(CASE WHEN len({TOKS.format(col=visible_sql('html'))}) > 0 THEN 1 END) AS gold_documents
FROM kept
"""

ORACLE["crawl_summary"] = f"""
WITH {_FETCHED},
acc AS (SELECT * FROM fetched WHERE coalesce(status >= 200 AND status < 300 AND (contains(ct, 'text/html') OR contains(ct, 'application/xhtml')), false)),
toks AS (SELECT page_id, unnest({TOKS.format(col=visible_sql('html'))}) AS term FROM acc),
offered AS (SELECT {norm_sql('url')} AS u FROM acc UNION SELECT unnest({links_sql('url', 'html')}) FROM acc)
SELECT (SELECT count(*) FROM acc) AS pages_stored,
       (SELECT count(*) FROM offered) AS urls_discovered,
       (SELECT count(*) FROM acc) AS silver_docs,
       (SELECT count(DISTINCT page_id) FROM toks) AS gold_docs,
       (SELECT count(DISTINCT term) FROM toks) AS terms,
       (SELECT CAST(max(fetched_ms) - min(fetched_ms) AS BIGINT) FROM acc) AS elapsed_ms,
       round((SELECT count(*) FROM acc) / greatest((SELECT (max(fetched_ms) - min(fetched_ms)) / 1000.0 FROM acc), 0.001), 6) AS pages_per_second
"""


# --- streaming twins (same results as the batch operators) --------------------------------

ORACLE["stream_silver"] = f"""
SELECT page_id, left(sha256(url), 16) AS id, {title_sql('html')} AS title,
       CAST(len({TOKS.format(col=visible_sql('html'))}) AS INTEGER) AS doc_len,
       array_to_string({links_sql('url', 'html')}, ' ') AS links
FROM pages
"""
ORACLE["stream_gold"] = f"""
WITH last AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'third crawl ' || text
      WHEN lang = 'fr' THEN (CASE WHEN n_chars > 1000 THEN text || ' ' || text ELSE '' END) ELSE text END AS text
  FROM documents),
d AS (SELECT doc_id, {TOKS.format(col='text')} AS toks FROM last),
post AS (SELECT doc_id, CAST(len(any_value(toks)) AS INTEGER) AS stat_len, term, CAST(count(*) AS INTEGER) AS tf
         FROM (SELECT doc_id, toks, unnest(toks) AS term FROM d) GROUP BY doc_id, term),
cs AS (SELECT (SELECT count(*) FROM d WHERE len(toks) > 0) AS n_docs, (SELECT count(DISTINCT term) FROM post) AS n_terms,
              (SELECT CAST(sum(len(toks)) AS BIGINT) FROM d) AS total_len)
SELECT doc_id, stat_len, term, tf, count(*) OVER (PARTITION BY term) AS df, n_docs, n_terms, total_len FROM post, cs
"""
ORACLE["stream_dedup"] = "SELECT DISTINCT 'https://u' || CAST(user_id AS VARCHAR) || '.example.com/' AS url FROM events"
ORACLE["stream_dedup_bounded"] = """
SELECT DISTINCT 'https://u' || CAST(user_id AS VARCHAR) || '.example.com/' AS url, strftime(ts, '%Y-%m-%d') AS day
FROM events WHERE ts IS NOT NULL
"""
ORACLE["stream_metrics"] = ORACLE["search_metrics"].replace("FROM events", "FROM events WHERE ts IS NOT NULL")
ORACLE["stream_politeness"] = """
WITH e AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN 'u' || CAST(user_id AS VARCHAR) END AS host, epoch_us(ts) // 1000 AS a
           FROM events WHERE ts IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY a, event_id) AS i FROM e WHERE host IS NOT NULL),
g AS (SELECT event_id, host, a,
             i * 1000 + max(a - i * 1000) OVER (PARTITION BY host ORDER BY i ROWS UNBOUNDED PRECEDING) AS grant_ms
      FROM r)
SELECT event_id, host, CAST(grant_ms - a AS BIGINT) AS wait_ms FROM g
UNION ALL SELECT event_id, host, CAST(0 AS BIGINT) FROM e WHERE host IS NULL
"""

ORACLE["silver_documents"] = f"""
WITH {_FETCHED},
p AS (SELECT url, html, {TOKS.format(col=visible_sql('html'))} AS toks FROM fetched
      WHERE coalesce(status >= 200 AND status < 300 AND (contains(ct, 'text/html') OR contains(ct, 'application/xhtml')), false))
SELECT left(sha256(url), 16) AS id, url, {title_sql('html')} AS title,
       array_to_string({links_sql('url', 'html')}, ' ') AS links,
       array_to_string(list_sort(list_transform(list_distinct(toks), lambda t: t || ':' || len(list_filter(toks, lambda x: x = t)))), ' ') AS terms,
       CAST(len(toks) AS INTEGER) AS documentLength,
       CAST(len(list_distinct(toks)) AS INTEGER) AS n_terms,
       CAST(len(toks) AS INTEGER) AS tf_total
FROM p
"""

ORACLE["page_search"] = f"""
WITH d AS (SELECT url, {title_sql('html')} AS title, {TOKS.format(col=visible_sql('html'))} AS toks FROM pages),
post AS (SELECT url, term, count(*) AS tf FROM (SELECT url, unnest(toks) AS term FROM d) GROUP BY url, term),
dl AS (SELECT url, CAST(len(toks) AS DOUBLE) AS doc_len, title FROM d WHERE len(toks) > 0),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
cs AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(doc_len) AS DOUBLE) / count(*) AS avgdl FROM dl),
q AS (SELECT DISTINCT unnest({TOKS.format(col=repr(_SEARCH_QUERY))}) AS term),
scored AS (
  SELECT p.url, round(sum(ln(1 + (cs.n - dfs.df + 0.5) / (dfs.df + 0.5)) * (p.tf * 2.2)
                        / (p.tf + 1.2 * (0.25 + 0.75 * dl.doc_len / cs.avgdl))), 6) AS score,
         CAST(count(*) AS INTEGER) AS matched
  FROM post p JOIN q ON p.term = q.term JOIN dfs ON dfs.term = p.term JOIN dl ON dl.url = p.url CROSS JOIN cs
  GROUP BY p.url),
top AS (SELECT url, score, matched, CAST(row_number() OVER (ORDER BY score DESC, matched DESC, url) AS INTEGER) AS rank
        FROM scored ORDER BY rank LIMIT 10)
SELECT top.url, score, matched, rank, dl.title,
       CASE WHEN regexp_matches(dl.title, '\\S') THEN dl.title END AS snippet
FROM top JOIN dl ON dl.url = top.url
"""

# The stream emits an expired poll once the watermark (max event time of the
# poll/finish rows, delay 0) has passed its deadline; polls still inside their
# lease when the input ends stay in state.
ORACLE["stream_lease"] = ORACLE["lease_recovery"].replace(
    "SELECT task, ts_ms AS poll_ms, CAST(ts_ms + 43200000 AS BIGINT) AS recover_ms, finish_ms IS NOT NULL AS late_finish",
    "SELECT task, ts_ms AS poll_ms, CAST(ts_ms + 43200000 AS BIGINT) AS recover_ms",
).replace(
    "WHERE kind = 'poll' AND (finish_ms IS NULL OR finish_ms > ts_ms + 43200000)",
    "WHERE kind = 'poll' AND (finish_ms IS NULL OR finish_ms > ts_ms + 43200000) AND ts_ms + 43200000 + 1 < (SELECT max(ts_ms) FROM e)",
)

ORACLE["page_doc_lookup"] = f"""
WITH d AS (SELECT url, {title_sql('html')} AS title, {TOKS.format(col=visible_sql('html'))} AS toks FROM pages),
dl AS (SELECT url, CAST(len(toks) AS INTEGER) AS doc_len, title FROM d WHERE len(toks) > 0),
t AS (SELECT DISTINCT unnest({links_sql('url', 'html')}) AS url FROM pages)
SELECT t.url, CAST(coalesce(dl.doc_len, 0) AS INTEGER) AS doc_len, dl.title,
       CASE WHEN regexp_matches(dl.title, '\\S') THEN dl.title END AS snippet
FROM t LEFT JOIN dl ON dl.url = t.url
"""
