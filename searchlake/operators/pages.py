"""Page ETL: raw HTML rows -> parsed pages, Silver documents and link edges.

All of it is narrow, per-row column work next to the scan; the wide HTML
column never crosses a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.functions import urls
from searchlake.functions.html import split_page, text_of, title_of
from searchlake.functions.text import term_counts, tokens
from searchlake.session import spread


def parse_pages(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, url, title, links, toks, doc_len)`` per page."""
    return page_columns(spread(pages), url, html, keep).withColumn("doc_len", F.size("toks").cast("int"))


def page_columns(pages: DataFrame, url: str, html: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, url, title, links, toks)``, per row: the page is cut into
    tokens once (Catalyst keeps a costly column that is used three times)."""
    cut = pages.select(*keep, F.col(url).alias("_url"), split_page(html).alias("_parts"))
    return cut.select(
        *keep,
        F.col("_url").alias("url"),
        title_of(F.col("_parts")).alias("title"),
        urls.page_links("_url", F.col("_parts")).alias("links"),
        tokens(text_of(F.col("_parts"))).alias("toks"),
    )


def silver_documents(parsed: DataFrame, processed_at=None, source_id: str | None = None) -> DataFrame:
    """M4 Silver rows ``(id, url, title, links, termFrequencies, documentLength,
    processedAt, sourceBronzeId)``.

    The term-frequency map is counted inside the row: rows that share a URL
    keep a map each, and nothing is shuffled.
    """
    if processed_at is None:
        ts = F.current_timestamp()
    elif isinstance(processed_at, Column):
        ts = processed_at
    else:
        ts = F.lit(processed_at)
    src = F.col(source_id) if source_id else urls.url_id("url")
    return parsed.select(
        urls.url_id("url").alias("id"),
        "url",
        "title",
        "links",
        F.map_from_entries(term_counts("toks")).alias("termFrequencies"),
        F.col("doc_len").alias("documentLength"),
        ts.cast("timestamp").alias("processedAt"),
        src.alias("sourceBronzeId"),
    )


def link_edges(parsed: DataFrame, src: str = "url") -> DataFrame:
    """G1: ``(src, pos, dst)`` one row per kept link, document order in ``pos``."""
    return explode_links(parsed.select(F.col(src).alias("src"), "links")).select("src", "pos", F.col("link").alias("dst"))


def explode_links(pages: DataFrame) -> DataFrame:
    """The other columns of ``pages``, ``pos`` and ``link`` for each entry of
    ``links``.  The outer form keeps Catalyst from evaluating the link
    expression once more for an inferred ``size(links) > 0``."""
    others = [c for c in pages.columns if c != "links"]
    out = pages.select(*others, F.posexplode_outer("links").alias("pos", "link")).where(F.col("link").isNotNull())
    return out.withColumn("pos", F.col("pos").cast("int"))
