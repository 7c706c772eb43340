"""Fixed values that must equal the reference behaviour for identical results.

These are stated plainly and in one place on purpose; operators take them as
keyword defaults so callers can override them.
"""

# --- fixed values: BM25 -------------------------------------------------------
BM25_K1 = 1.2
BM25_B = 0.75

# --- fixed values: tokenizer --------------------------------------------------
TOKEN_PATTERN = "[a-z0-9]+"
MIN_TOKEN_LENGTH = 2

# --- fixed values: search API limits -----------------------------------------
DEFAULT_LIMIT = 10
MIN_LIMIT = 1
MAX_LIMIT = 100

# --- fixed values: crawler configuration defaults ----------------------------
DEFAULT_MAX_DEPTH = 3
DEFAULT_MAX_PAGES = 100
DEFAULT_WORKERS = 4
DEFAULT_POLITENESS_DELAY_MS = 1000
USER_AGENT = "ConcurrentCrawler/1.0"

# --- fixed values: fetch retries ----------------------------------------------
MAX_FETCH_ATTEMPTS = 3
INITIAL_BACKOFF_MS = 200
MAX_BACKOFF_EXPONENT = 10
HTML_CONTENT_TYPES = ("text/html", "application/xhtml")

# --- fixed values: latency report ---------------------------------------------
LATENCY_PERCENTILES = (0.50, 0.95, 0.99)

# --- fixed values: HTML elements that part words in displayed text ------------
BLOCK_TAGS = (
    "address", "applet", "article", "aside", "audio", "blockquote", "body", "canvas", "caption", "center", "col",
    "colgroup", "dd", "del", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "frame", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "ins", "li",
    "link", "listing", "main", "marquee", "math", "menu", "meta", "nav", "noframes", "noscript", "ol", "p",
    "plaintext", "pre", "script", "section", "style", "svg", "table", "tbody", "td", "template", "tfoot", "th",
    "thead", "title", "tr", "ul", "video",
)

# --- fixed values: HTML elements that don't begin the body of a page ----------
HEAD_TAGS = ("html", "head", "base", "basefont", "bgsound", "link", "meta", "noscript", "template")

# --- fixed values: numeric references read as Windows-1252 (HTML standard) ----
WINDOWS_1252 = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020, 0x87: 0x2021, 0x88: 0x02C6,
    0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152, 0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C,
    0x94: 0x201D, 0x95: 0x2022, 0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A,
    0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178,
}
