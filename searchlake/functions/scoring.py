"""Okapi BM25 as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchlake.constants import BM25_B, BM25_K1


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def idf(n_docs, df) -> Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5)); 0 when N <= 0 or df <= 0."""
    n, d = _c(n_docs).cast("double"), _c(df).cast("double")
    value = F.log(1.0 + (n - d + 0.5) / (d + 0.5))
    return F.when((n > 0) & (d > 0), value).otherwise(F.lit(0.0))


def term_score(idf_col, tf, doc_len, avgdl, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """idf * tf(k1+1) / (tf + k1(1 - b + b len/avgdl)).

    0 when tf, idf's df or len is not positive (callers pass idf 0 for
    df <= 0); a non-positive avgdl is replaced by the document length.
    """
    tf_, len_ = _c(tf).cast("double"), _c(doc_len).cast("double")
    avg = F.when(_c(avgdl) > 0, _c(avgdl).cast("double")).otherwise(len_)
    norm = 1.0 - b + b * (len_ / avg)
    value = _c(idf_col) * (tf_ * (k1 + 1.0)) / (tf_ + k1 * norm)
    return F.when((tf_ > 0) & (len_ > 0), value).otherwise(F.lit(0.0))
