"""Text columns: tokenizer, per-document term counts, HTML title and body text.

Every function here maps Columns to a Column using built-in Spark SQL
functions only, so the work runs in the JVM next to the Parquet scan and
never leaves the row (no shuffle, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchlake.constants import MIN_TOKEN_LENGTH, TOKEN_PATTERN
from searchlake.functions.html import let, split_page, text_of, title_of


#: Whole runs of ``TOKEN_PATTERN`` of the least length, in one pass.
_LONG_RUN = TOKEN_PATTERN.removesuffix("+") + f"{{{MIN_TOKEN_LENGTH},}}+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(text) -> Column:
    """All ``[a-z0-9]+`` runs of the lower-cased text with length >= 2.

    Accented letters act as separators; no stemming, no stop words.
    """
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(_LONG_RUN), F.lit(0))


def query_tokens(text) -> Column:
    """Tokens with repeats removed, first occurrence order kept."""
    return F.array_distinct(tokens(text))


def term_counts(toks) -> Column:
    """``array<struct(term, tf)>`` of one row's tokens, by term: runs of the
    sorted tokens, so nothing but the row itself is held."""

    def runs(s: Column) -> Column:
        first = F.when(
            F.size(s) > 0, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        ).otherwise(F.array().cast("array<int>"))

        def counted(at: Column) -> Column:
            return F.transform(
                at, lambda i, n: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, n + 1), F.size(s)) - i).cast("int").alias("tf"))
            )

        return let(first, counted)

    return let(F.sort_array(_c(toks)), runs)


def html_visible_text(html) -> Column:
    """Displayed text of a page's body (see ``functions.html``)."""
    return let(split_page(html), text_of)


def html_title(html) -> Column:
    """The page's title, entities decoded, blanks collapsed; '' if none."""
    return let(split_page(html), title_of)


def snippet(title) -> Column:
    """Snippet = title when it has a non-blank character, else NULL."""
    t = _c(title)
    return F.when(t.rlike(r"\S"), t)
